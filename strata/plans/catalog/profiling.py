"""Profile reports over the whole tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from strata.operators import comoments, profile, quantiles, sketches, sparse_bins
from strata.operators.contracts import Rule, contract_check, leak_audit
from strata.plans.catalog.registry import query
from strata.plans.loan_view import LOAN_VIEW_SQL, loan_view, table
from strata.runtime import scratch_path
from strata.sources import describe_schema

LV_COLUMNS = [
    "loan_id", "loan_amnt", "annual_inc", "int_rate", "grade", "loan_status",
    "default_flag", "home_ownership", "issue_d", "earliest_cr_line", "dti",
]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rounded(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _union(parts):
    return "\nUNION ALL\n".join(parts)


@query(
    """
WITH c AS (SELECT o_orderpriority AS grade, o_orderstatus AS loan_status, count(*) AS n
           FROM orders GROUP BY ALL)
SELECT grade, loan_status, concat_ws('_', grade, loan_status) AS stratum, n,
       round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM c) * 100, 2) AS pct
FROM c"""
)
def stratum_counts(spark, sf):
    roles = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("grade"), F.col("o_orderstatus").alias("loan_status")
    )
    return profile.pct_of_total(roles, ["grade", "loan_status"]).select(
        "grade", "loan_status", F.concat_ws("_", "grade", "loan_status").alias("stratum"), "n", "pct"
    )


# The columns of the orders table with their Spark types and kinds.
_ORDER_SCHEMA = [
    ("o_orderkey", "bigint", "numeric"),
    ("o_custkey", "bigint", "numeric"),
    ("o_orderstatus", "string", "categorical"),
    ("o_totalprice", "double", "numeric"),
    ("o_orderdate", "timestamp_ntz", "other"),
    ("o_orderpriority", "string", "categorical"),
]


@query(
    _union(
        f"""
SELECT {i} AS position, '{c}' AS "column", '{t}' AS type, '{k}' AS kind,
       count(*) FILTER ({c} IS NULL) AS n_null FROM orders"""
        for i, (c, t, k) in enumerate(_ORDER_SCHEMA, start=1)
    )
)
def schema_description(spark, sf):
    orders = table(spark, sf, "orders")
    nulls = profile.null_profile(orders).select("column", "n_null")
    return describe_schema(orders).join(nulls, "column")


@query("SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def table_shape(spark, sf):
    return profile.table_shape(table(spark, sf, "lineitem"))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def frequency(spark, sf):
    return profile.frequency(table(spark, sf, "part"), "p_brand")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def frequency_by_two(spark, sf):
    return profile.frequency(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(
    "WITH "
    + LOAN_VIEW_SQL
    + _union(
        f"""
SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM lv GROUP BY {c}"""
        for c in ("grade", "loan_status", "home_ownership", "int_rate")
    )
)
def frequency_all(spark, sf):
    return profile.frequency_all(loan_view(spark, sf), ["grade", "loan_status", "home_ownership", "int_rate"])


_NULLS_SQL = "WITH " + LOAN_VIEW_SQL + ", np AS (" + _union(
    f"""
SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_null, CAST(0 AS BIGINT) AS n_nan,
       round(CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) * 100 / count(*), 6) AS pct_null FROM lv"""
    for c in LV_COLUMNS
) + ")"


@query(_NULLS_SQL + "\nSELECT * FROM np")
def null_profile(spark, sf):
    return _rounded(profile.null_profile(loan_view(spark, sf)), 6, "pct_null")


@query(_NULLS_SQL + '\nSELECT * FROM np ORDER BY n_null DESC, "column" LIMIT 5')
def top_missing(spark, sf):
    return _rounded(profile.top_missing(loan_view(spark, sf), 5), 6, "pct_null")


@query(
    _NULLS_SQL
    + f"""
SELECT round(CAST(sum(n_null) AS DOUBLE) * 100 / ((SELECT count(*) FROM lv) * {len(LV_COLUMNS)}), 6)
       AS missing_pct FROM np"""
)
def missing_pct(spark, sf):
    return _rounded(profile.missing_pct(loan_view(spark, sf)), 6, "missing_pct")


@query(
    "WITH "
    + LOAN_VIEW_SQL
    + ", typed AS (SELECT loan_amnt, annual_inc, try_cast(replace(int_rate, '%', '') AS DOUBLE) AS int_rate, "
    + "CAST(dti AS DOUBLE) AS dti FROM lv)"
    + _union(
        f"""
SELECT '{c}' AS "column", round(avg({c}), 4) AS avg, min({c}) AS min, max({c}) AS max FROM typed"""
        for c in ("loan_amnt", "annual_inc", "int_rate", "dti")
    )
)
def scalar_summary(spark, sf):
    lv = loan_view(spark, sf).withColumn("int_rate", F.regexp_replace("int_rate", "%", "").try_cast("double"))
    return _rounded(profile.scalar_summary(lv, ["loan_amnt", "annual_inc", "int_rate", "dti"]), 4, "avg")


def _quantile_sql(function, source, cols, ps, digits=6):
    return _union(
        f"""
SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS p, round({function}({c}, {p}), {digits}) AS quantile FROM {source}"""
        for c in cols
        for p in ps
    )


_PS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query(_quantile_sql("quantile_cont", "lineitem", LINE_NUMBERS, _PS))
def quantiles_exact(spark, sf):
    return _rounded(quantiles.quantiles(table(spark, sf, "lineitem"), LINE_NUMBERS, _PS), 6, "quantile")


@query(_quantile_sql("quantile_disc", "events", ["value"], _PS))
def quantiles_nearest_rank(spark, sf):
    got = quantiles.quantiles(table(spark, sf, "events"), ["value"], _PS, interpolate=False)
    return _rounded(got, 6, "quantile")


@query(_quantile_sql("quantile_cont", "lineitem", LINE_NUMBERS, _PS))
def quantiles_radix(spark, sf):
    """The same by counts of key digits alone: nothing is sketched, and no task gets an interval."""
    got = quantiles.quantiles(table(spark, sf, "lineitem"), LINE_NUMBERS, _PS, method="radix")
    return _rounded(got, 6, "quantile")


@query()
def quantiles_sketch(spark, sf):
    return quantiles.quantiles(table(spark, sf, "lineitem"), LINE_NUMBERS, _PS, accuracy=10_000)


@query(
    _union(
        f"""
SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS DOUBLE) AS min,
       round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS median, round(avg({c}), 4) AS mean,
       round(stddev_samp({c}), 4) AS stddev, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in [*LINE_NUMBERS, "l_linenumber"]
    )
)
def numeric_summary(spark, sf):
    got = profile.numeric_summary(table(spark, sf, "lineitem"), [*LINE_NUMBERS, "l_linenumber"])
    return _rounded(_rounded(got, 4, "mean", "stddev"), 6, "median")


@query(
    "WITH src AS (SELECT event_id, user_id, value FROM events), q AS ("
    + _union(
        f"""
SELECT '{c}' AS "column", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q2,
       quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, stddev_samp({c}) AS stddev FROM src"""
        for c in ("event_id", "user_id", "value")
    )
    + "), long AS ("
    + _union(
        f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS v FROM src""" for c in ("event_id", "user_id", "value")
    )
    + """)
SELECT q."column", round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3, round(stddev, 4) AS stddev,
       count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       round(CAST(count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS DOUBLE) * 100 / count(*), 6)
         AS pct_outliers
FROM long JOIN q ON long."column" = q."column" GROUP BY ALL
ORDER BY n_outliers DESC, 1 LIMIT 10"""
)
def iqr_outliers(spark, sf):
    got = profile.iqr_outliers(table(spark, sf, "events"), ["event_id", "user_id", "value"])
    return _rounded(_rounded(got, 6, "q1", "q2", "q3", "pct_outliers"), 4, "stddev")


@query(
    "WITH src AS (SELECT l_extendedprice, l_quantity FROM lineitem)"
    + _union(
        f"""
SELECT '{c}' AS "column", round(any_value(low), 6) AS low, round(any_value(high), 6) AS high,
       count(*) FILTER ({c} < low OR {c} > high) AS n_outliers
FROM src, (SELECT quantile_cont({c}, 0.01) AS low, quantile_cont({c}, 0.99) AS high FROM src)"""
        for c in ("l_extendedprice", "l_quantity")
    )
)
def tail_outliers(spark, sf):
    got = profile.tail_outliers(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])
    return _rounded(got, 6, "low", "high")


@query(
    _union(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for a in LINE_NUMBERS
        for b in LINE_NUMBERS
    )
)
def correlation(spark, sf):
    return _rounded(profile.correlation(table(spark, sf, "lineitem"), LINE_NUMBERS), 6, "r")


def _wide_columns() -> dict[str, str]:
    """141 columns of the embeddings as SQL of either engine: parts, shifted parts and products, with gaps planted."""
    part = [f"CAST(embedding[{{{i}}}] AS DOUBLE)" for i in range(64)]
    made = {f"e{i}": p for i, p in enumerate(part)}
    made |= {f"s{i}": f"100 + {p} * {i + 1}" for i, p in enumerate(part)}
    made |= {f"p{i}": f"{part[i]} * {part[i + 1]}" for i in range(13)}
    gap = "CASE WHEN (vec_id + {k}) % 10 = 0 THEN NULL WHEN (vec_id + {k}) % 17 = 0 THEN CAST('NaN' AS DOUBLE) ELSE {v} END"
    return {c: gap.replace("{k}", str(k)).replace("{v}", v) for k, (c, v) in enumerate(made.items())}


def _indexed(sql: str, base: int) -> str:
    """Array positions, counted from 0 in Spark and from 1 in the oracle."""
    return re.sub(r"\[\{(\d+)\}\]", lambda m: f"[{int(m[1]) + base}]", sql)


@query(
    "WITH w AS (SELECT vec_id, unnest([" + ", ".join(f"'{c}'" for c in _wide_columns()) + "]) AS c, unnest(["
    + ", ".join(_indexed(v, 1) for v in _wide_columns().values())
    + """]) AS v FROM embeddings), g AS (SELECT * FROM w WHERE v IS NOT NULL AND NOT isnan(v))
SELECT x.c AS a, y.c AS b, count(*) AS n, round(corr(x.v, y.v), 5) AS r
FROM g x JOIN g y ON x.vec_id = y.vec_id GROUP BY 1, 2"""
)
def correlation_wide(spark, sf):
    """All ordered pairs of 141 columns in one scan, NULL and NaN dropped pairwise."""
    wide = table(spark, sf, "embeddings").selectExpr(*[f"{_indexed(v, 0)} AS {c}" for c, v in _wide_columns().items()])
    return _rounded(comoments.correlations(wide, wide.columns), 5, "r")


_HISTOGRAM_SQL = """
WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
c AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / {bins})), {bins} - 1) AS INTEGER) AS bin, count(*) AS n
      FROM events, e GROUP BY 1),
h AS (SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * ((hi - lo) / {bins}) AS low,
             lo + (g.bin + 1) * ((hi - lo) / {bins}) AS high, coalesce(n, 0) AS n
      FROM range({bins}) g(bin) CROSS JOIN e LEFT JOIN c ON c.bin = g.bin)"""


@query(
    _HISTOGRAM_SQL.replace("{bins}", "20.0").replace("range(20.0)", "range(20)")
    + "\nSELECT bin, round(low, 6) AS low, round(high, 6) AS high, n FROM h"
)
def histogram(spark, sf):
    return _rounded(profile.histogram(table(spark, sf, "events"), "value", 20), 6, "low", "high")


@query(
    """
WITH e AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
                  quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events),
b AS (SELECT lo, hi, CAST(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * iqr / cbrt(n))) AS BIGINT) AS bins
      FROM e),
c AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / bins)), bins - 1) AS BIGINT) AS bin, count(*) AS n
      FROM events, b GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / bins), 6) AS low,
       round(lo + (g.bin + 1) * ((hi - lo) / bins), 6) AS high, coalesce(c.n, 0) AS n
FROM (SELECT lo, hi, bins, unnest(range(bins)) AS bin FROM b) g LEFT JOIN c ON c.bin = g.bin"""
)
def histogram_auto(spark, sf):
    return _rounded(profile.histogram(table(spark, sf, "events"), "value", "auto"), 6, "low", "high")


@query(
    _HISTOGRAM_SQL.replace("{bins}", "200.0").replace("range(200.0)", "range(200)")
    + """,
s AS (SELECT count(value) AS cnt, stddev_samp(value) * pow(CAST(count(value) AS DOUBLE), -0.2) AS h FROM events),
g AS (SELECT CAST(p.point AS INTEGER) AS point, lo + p.point * (hi - lo) / 49.0 AS x FROM range(50) p(point), e)
SELECT point, round(x, 6) AS x,
       round(sum(n * exp(-0.5 * pow((x - (low + high) / 2) / s.h, 2))) / (s.cnt * s.h * sqrt(2 * pi())), 8) AS density
FROM g, h, s WHERE h.n > 0 GROUP BY point, x, s.cnt, s.h"""
)
def density(spark, sf):
    got = profile.density(table(spark, sf, "events"), "value", points=50, bins=200)
    return _rounded(_rounded(got, 6, "x"), 8, "density")


@query(
    _union(
        f"""
SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high,
       round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, TRUE AS distinct_close, TRUE AS median_close FROM lineitem"""
        for c in [*LINE_NUMBERS, "l_linenumber"]
    )
)
def merged_profile(spark, sf):
    """Stored states per ship month, merged: exact moments, and estimates within their error of exact counts."""
    lines, cols = table(spark, sf, "lineitem"), [*LINE_NUMBERS, "l_linenumber"]
    path = scratch_path(spark, "states")
    sketches.states(lines, cols, F.date_format("l_shipdate", "yyyy-MM")).write.parquet(path)
    got = sketches.summary(sketches.merged(spark.read.parquet(path)), [0.5])
    estimates = {r["column"]: (r["n_distinct"], r["q50"]) for r in got.collect()}  # a row per column
    exact = lines.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    (F.abs(F.count_distinct(c) - F.lit(n)) <= 0.06 * F.count_distinct(c)).alias("distinct_close"),
                    # the median's rank, by counting: the rows below it and those up to it enclose one half
                    ((F.count_if(F.col(c) < m) <= 0.52 * F.count(c)) & (F.count_if(F.col(c) <= m) >= 0.48 * F.count(c))).alias("median_close"),
                )
                for c, (n, m) in estimates.items()
            ]
        ).alias("rows")
    ).select(F.inline("rows"))
    out = got.select("column", "n_rows", "n_null", "low", "high", "mean", "stddev").join(exact, "column")
    return _rounded(out, 4, "mean", "stddev")


#: Values with gaps, infinities and a far tail planted, as SQL of either engine.
_TAIL = """CASE event_id % 1000 WHEN 0 THEN 1e12 WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 2 THEN CAST('Infinity' AS DOUBLE)
  WHEN 3 THEN NULL WHEN 4 THEN CAST('-Infinity' AS DOUBLE) ELSE value END"""

_TAIL_SQL = f"""
WITH t AS (SELECT {_TAIL} AS v FROM events), f AS (SELECT v FROM t WHERE isfinite(v)),
e AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) AS sd, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM f)"""


@query(
    _TAIL_SQL
    + """, b AS (SELECT lo, hi, CAST(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * iqr / cbrt(n))) AS BIGINT) AS bins FROM e),
w AS (SELECT lo, bins, (hi - lo) / bins AS width FROM b)
SELECT CAST(least(floor((v - lo) / width), bins - 1) AS BIGINT) AS bin, round(any_value(lo) + bin * any_value(width), 2) AS low,
  round(any_value(lo) + (bin + 1) * any_value(width), 2) AS high, count(*) AS n FROM f, w GROUP BY 1
UNION ALL SELECT NULL, v, v, count(*) FROM t WHERE isinf(v) GROUP BY v"""
)
def histogram_heavy_tail(spark, sf):
    """Automatic bins with values far out: some 10^10 bins, of which the occupied ones exist."""
    rows = table(spark, sf, "events").selectExpr(f"{_TAIL} AS v")
    return _rounded(profile.histogram(rows, "v", "auto"), 2, "low", "high")


@query(
    _TAIL_SQL
    + """, h AS (SELECT lo, n, greatest(0.9 * least(sd, iqr / 1.349) * pow(n, -0.2), (hi - lo) / 1125899906842624) AS h FROM e),
c AS (SELECT (floor((v - lo) / (h / 8)) + 0.5) * ((h / 8) / (h / 2)) AS centre, count(*) AS k FROM f, h GROUP BY 1),
p AS (SELECT centre, k, unnest(range(CAST(ceil(centre - 8) AS BIGINT), CAST(floor(centre + 8) AS BIGINT) + 1)) AS point FROM c)
SELECT point, round(any_value(lo) + point * (any_value(h) / 2), 2) AS x,
  round(sum(k * exp(-0.5 * pow((point - centre) * 0.5, 2))) / any_value(n * h * sqrt(2 * pi())), 8) AS density FROM p, h GROUP BY point"""
)
def density_heavy_tail(spark, sf):
    """A kernel density near the occupied cells, which far values neither widen nor lengthen."""
    rows = table(spark, sf, "events").selectExpr(f"{_TAIL} AS v")
    return _rounded(_rounded(sparse_bins.density(rows, "v"), 2, "x"), 8, "density")


@query(
    "WITH "
    + LOAN_VIEW_SQL
    + _union(
        f"""
SELECT CAST(right(issue_d, 4) AS INTEGER) AS year, '{c}' AS "column", count(*) AS n_rows,
       round(CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) * 100 / count(*), 6) AS pct_null FROM lv GROUP BY 1"""
        for c in ("loan_amnt", "int_rate", "loan_status")
    )
)
def null_by_year(spark, sf):
    lv = loan_view(spark, sf)
    year = F.year(F.try_to_date(F.concat(F.lit("01-"), "issue_d"), "dd-MMM-yyyy"))
    return _rounded(profile.null_rate_by(lv, year, ["loan_amnt", "int_rate", "loan_status"], "year"), 6, "pct_null")


@query(
    "WITH "
    + LOAN_VIEW_SQL
    + """
SELECT 'loan_id:not_null' AS rule, count(*) FILTER (loan_id IS NULL) AS violations FROM lv
UNION ALL SELECT 'loan_amnt:not_null', count(*) FILTER (loan_amnt IS NULL) FROM lv
UNION ALL SELECT 'annual_inc:range', count(*) FILTER (annual_inc < 0) FROM lv
UNION ALL SELECT 'dti:range', count(*) FILTER (dti < 0 OR dti > 100) FROM lv
UNION ALL SELECT 'loan_status:in_set', count(*) FILTER (loan_status NOT IN ('F', 'O')) FROM lv
UNION ALL SELECT 'dti:type', 0
UNION ALL SELECT 'int_rate:type', count(*) FROM lv
UNION ALL SELECT 'loan_id:unique', count(*) - count(DISTINCT loan_id) FROM lv
UNION ALL SELECT 'grade+issue_d:unique', (SELECT count(*) FROM lv) - (SELECT count(*) FROM (SELECT DISTINCT grade, issue_d FROM lv))"""
)
def contract_report(spark, sf):
    rules = [
        Rule("loan_id", "not_null"),
        Rule("loan_amnt", "not_null"),
        Rule("annual_inc", "range", (0, None)),
        Rule("dti", "range", (0, 100)),
        Rule("loan_status", "in_set", ("F", "O")),
        Rule("dti", "type", ("int",)),
        Rule("int_rate", "type", ("double",)),
        Rule("loan_id", "unique"),
        Rule(("grade", "issue_d"), "unique"),
    ]
    return contract_check(loan_view(spark, sf), rules)


@query(
    "WITH "
    + LOAN_VIEW_SQL
    + ", cells AS ("
    + _union(
        f"""
SELECT '{c}' AS "column", {c} AS value, default_flag, count(*) AS n FROM lv GROUP BY ALL"""
        for c in ("grade", "loan_status", "home_ownership", "int_rate")
    )
    + """), vals AS (
SELECT "column", value, sum(n) AS rows_, max(n) AS top, count(*) AS labels FROM cells GROUP BY ALL)
SELECT "column", count(*) AS n_values, CAST(sum(rows_) AS BIGINT) AS n_rows,
       round(CAST(sum(top) AS DOUBLE) / sum(rows_), 6) AS purity,
       round(CAST(sum(CASE WHEN labels = 1 THEN rows_ ELSE 0 END) AS DOUBLE) * 100 / sum(rows_), 6) AS pct_determined
FROM vals GROUP BY "column\""""
)
def leak_report(spark, sf):
    got = leak_audit(loan_view(spark, sf), "default_flag", ["grade", "loan_status", "home_ownership", "int_rate"])
    return _rounded(got, 6, "purity", "pct_determined")
