"""Sampling, splitting and folds over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import joins, sampling
from strata.plans.catalog.registry import query
from strata.plans.loan_view import LOAN_VIEW_SQL, order_view, table

LV = "WITH " + LOAN_VIEW_SQL
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def u_sql(*key: str, seed: int = 42) -> str:
    """The keyed uniform number in DuckDB."""
    text = " || ':' || ".join([f"'{seed}'", *key])
    return f"(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) / CAST(4503599627370496 AS DOUBLE))"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")


_ORDERS_SQL = "SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice FROM orders"


@query(f"{_ORDERS_SQL} WHERE {u_sql('o_orderkey')} < 0.1")
def sample_fraction(spark, sf):
    return sampling.sample_fraction(_orders(spark, sf), 0.1, 42, "o_orderkey")


@query()
def sample_fraction_unkeyed(spark, sf):
    return sampling.sample_fraction(_orders(spark, sf), 0.1, 42)


@query(f"{_ORDERS_SQL} WHERE {u_sql('o_orderkey', seed=7)} < 0.1")
def sample_by_strata(spark, sf):
    return sampling.sample_by(_orders(spark, sf), ["o_orderpriority", "o_orderstatus"], 0.1, 7, "o_orderkey")


@query(
    LV
    + f"""
SELECT loan_id, loan_status FROM lv
WHERE {u_sql('loan_id')} < CASE WHEN loan_status = 'F' THEN 0.5 WHEN loan_status = 'O' THEN 0.1
                                WHEN loan_status IS NULL THEN 0.25 ELSE 0 END"""
)
def sample_by_fractions(spark, sf):
    lv = order_view(spark, sf).select("loan_id", "loan_status")
    return sampling.sample_by(lv, "loan_status", {"F": 0.5, "O": 0.1, None: 0.25}, 42, "loan_id")


@query(
    f"""
SELECT *, CASE WHEN {u_sql(*LINE_KEY)} >= 0.9 THEN 2 WHEN {u_sql(*LINE_KEY)} >= 0.8 THEN 1 ELSE 0 END AS part
FROM (SELECT {', '.join(LINE_KEY)}, l_quantity FROM lineitem)"""
)
def random_split(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity")
    return sampling.random_split(lines, [0.8, 0.1, 0.1], 42, LINE_KEY)


@query(f"SELECT *, CASE WHEN {u_sql('o_orderkey')} < 0.2 THEN 'test' ELSE 'train' END AS part FROM ({_ORDERS_SQL})")
def split_by_sample(spark, sf):
    train, test = sampling.split_by_sample(_orders(spark, sf), 0.2, 42, "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(f"{_ORDERS_SQL} ORDER BY {u_sql('o_orderkey')}, o_orderkey LIMIT 1000")
def exact_rows(spark, sf):
    return sampling.exact_rows(_orders(spark, sf), 1000, 42, "o_orderkey")


@query(f"{_ORDERS_SQL} WHERE {u_sql('o_orderkey')} * (SELECT count(*) FROM orders) < 5000.0")
def limit_rows(spark, sf):
    return sampling.limit_rows(_orders(spark, sf), 5000, 42, "o_orderkey")


@query(
    f"""
SELECT o_orderkey, CAST(f AS DOUBLE) AS fraction
FROM (SELECT o_orderkey, {u_sql('o_orderkey')} AS u FROM orders), unnest([0.1, 0.3, 0.5, 0.7, 1.0]) AS t(f)
WHERE u < CAST(f AS DOUBLE)"""
)
def fraction_ladder(spark, sf):
    keys = table(spark, sf, "orders").select("o_orderkey")
    return sampling.fraction_ladder(keys, [0.1, 0.3, 0.5, 0.7, 1.0], 42, "o_orderkey")


RANKED_SQL = (
    LV
    + """, ranked AS (
  SELECT loan_id, grade, loan_status,
         row_number() OVER (PARTITION BY grade, loan_status ORDER BY md5('42:' || loan_id), loan_id) AS r,
         count(*) OVER (PARTITION BY grade, loan_status) AS n FROM lv)"""
)


def _strata(spark, sf):
    return order_view(spark, sf).select("loan_id", "grade", "loan_status")


@query(RANKED_SQL + "\nSELECT loan_id, grade, loan_status, r <= floor(n * CAST(0.2 AS DOUBLE) + 0.5) AS is_test FROM ranked")
def stratified_split(spark, sf):
    return sampling.mark_stratified_test(_strata(spark, sf), ["grade", "loan_status"], 0.2, 42, "loan_id")


@query(RANKED_SQL + "\nSELECT loan_id, grade, loan_status, CAST((r - 1) * 5 // n AS INTEGER) AS fold FROM ranked")
def stratified_kfolds(spark, sf):
    return sampling.stratified_kfolds(_strata(spark, sf), ["grade", "loan_status"], 5, 42, "loan_id")


@query(
    f"""
WITH r AS (SELECT {', '.join(LINE_KEY)}, l_returnflag,
                  row_number() OVER (PARTITION BY l_returnflag ORDER BY
                    md5('1:' || {" || ':' || ".join(LINE_KEY)}), {', '.join(LINE_KEY)}) AS r,
                  count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT {', '.join(LINE_KEY)}, l_returnflag, CAST((r - 1) * 3 // n AS INTEGER) AS fold FROM r"""
)
def stratified_kfolds_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_KEY, "l_returnflag")
    return sampling.stratified_kfolds(lines, "l_returnflag", 3, 1, LINE_KEY)


_COMPARE_SQL = (
    RANKED_SQL
    + """, p AS (SELECT grade, loan_status, count(*) AS original FROM lv GROUP BY ALL),
s AS (SELECT grade, loan_status, count(*) AS sampled FROM ranked
      WHERE r <= floor(n * CAST(0.1 AS DOUBLE) + 0.5) GROUP BY ALL),
cmp AS (
  SELECT p.grade, p.loan_status, original,
         round(CAST(original AS DOUBLE) / (SELECT sum(original) FROM p) * 100, 2) AS pct_original,
         coalesce(sampled, 0) AS sampled,
         round(CAST(coalesce(sampled, 0) AS DOUBLE) / original * 100, 2) AS pct_sampled
  FROM p LEFT JOIN s ON p.grade IS NOT DISTINCT FROM s.grade AND p.loan_status IS NOT DISTINCT FROM s.loan_status)"""
)


@query(_COMPARE_SQL + "\nSELECT * FROM cmp")
def compare_distribution(spark, sf):
    rows = _strata(spark, sf)
    _, sample = sampling.stratified_split(rows, ["grade", "loan_status"], 0.1, 42, "loan_id")
    return sampling.compare_distribution(rows, sample, ["grade", "loan_status"])


@query(
    _COMPARE_SQL
    + """
SELECT round(max(abs(CAST(sampled AS DOUBLE) / (SELECT sum(sampled) FROM cmp)
                     - CAST(original AS DOUBLE) / (SELECT sum(original) FROM cmp))), 6) AS max_abs_diff FROM cmp"""
)
def share_deviation(spark, sf):
    rows = _strata(spark, sf)
    _, sample = sampling.stratified_split(rows, ["grade", "loan_status"], 0.1, 42, "loan_id")
    out = sampling.share_deviation(rows, sample, ["grade", "loan_status"])
    return out.select(F.round("max_abs_diff", 6).alias("max_abs_diff"))


@query(
    LV
    + f"""
SELECT loan_id, loan_amnt, loan_status FROM lv WHERE NOT {u_sql('loan_id')} < 0.2"""
)
def remainder(spark, sf):
    rows = order_view(spark, sf).select("loan_id", "loan_amnt", "loan_status")
    return joins.remainder(rows, sampling.sample_fraction(rows, 0.2, 42, "loan_id"))


@query(
    """
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey IS NOT DISTINCT FROM c.c_nationkey AND s.s_acctbal < -900)
GROUP BY ALL"""
)
def remainder_by_key(spark, sf):
    customers = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "nation")
    suppliers = table(spark, sf, "supplier").filter("s_acctbal < -900").withColumnRenamed("s_nationkey", "nation")
    left = joins.remainder(customers, suppliers, "nation")
    return left.groupBy("c_mktsegment", F.col("nation").alias("c_nationkey")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem
EXCEPT ALL SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem WHERE l_discount < 0.03"""
)
def row_difference(spark, sf):
    lines = table(spark, sf, "lineitem")
    cols = ["l_returnflag", "l_linestatus", "l_quantity"]
    return joins.row_difference(lines.select(*cols), lines.filter(F.col("l_discount") < 0.03).select(*cols))


@query(
    """
SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1995 AND 1998 THEN 'train'
                        WHEN year(o_orderdate) = 1999 THEN 'val' WHEN year(o_orderdate) = 2000 THEN 'test' END AS split
FROM orders"""
)
def temporal_split(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    out = sampling.temporal_split(rows, "o_orderdate", (1995, 1998), (1999, 1999), (2000, 2000))
    return out.drop("o_orderdate")
