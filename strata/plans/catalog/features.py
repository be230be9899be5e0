"""Feature encoding over the whole tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strata.operators import features
from strata.plans.catalog.registry import query
from strata.plans.loan_view import LOAN_VIEW_SQL, loan_view, order_view, table

PART_COLUMNS = ["p_name", "p_brand", "p_type"]


def _index_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", {c} AS value,
       CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS idx, count(*) AS n
FROM part GROUP BY {c}"""


@query("\nUNION ALL".join(_index_sql(c) for c in PART_COLUMNS))
def string_index(spark, sf):
    indexed = features.index_strings(table(spark, sf, "part").select(*PART_COLUMNS), PART_COLUMNS)
    pairs = F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.col(f"{c}_idx").cast("int").alias("idx"))
                for c in PART_COLUMNS
            ]
        )
    )
    return indexed.select(pairs).groupBy("column", "value", "idx").agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH "
    + LOAN_VIEW_SQL
    + "\nUNION ALL".join(
        f"""
SELECT '{c}' AS "column",
       CAST(row_number() OVER (ORDER BY {c} IS NULL, count(*) DESC, {c}) - 1 AS INTEGER) AS slot, count(*) AS n
FROM lv GROUP BY {c}"""
        for c in ("grade", "loan_status")
    )
)
def one_hot_counts(spark, sf):
    return features.one_hot_counts(order_view(spark, sf), ["grade", "loan_status"])


_SLOT_SQL = """
SELECT p_partkey, CAST({base} + i.idx AS BIGINT) AS slot, CAST(1 AS DOUBLE) AS value FROM part JOIN (
  SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx FROM part GROUP BY {c}) i ON i.v = {c}"""


@query(
    "SELECT p_partkey, CAST(0 AS BIGINT) AS slot, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT p_partkey, 1, p_retailprice FROM part"
    + "".join(
        "\nUNION ALL" + _SLOT_SQL.format(c=c, base="2" + "".join(f" + (SELECT count(DISTINCT {p}) + 1 FROM part)" for p in PART_COLUMNS[:k]))
        for k, c in enumerate(PART_COLUMNS)
    )
)
def one_hot_slots(spark, sf):
    """The entries of each part's sparse feature vector."""
    rows, _ = features.one_hot_slots(table(spark, sf, "part"), ["p_size", "p_retailprice"], PART_COLUMNS)
    return rows.select("p_partkey", F.inline("slots"))


@query(
    """
SELECT event_id, round(value / (SELECT stddev_samp(value) FROM events), 6) AS value_std,
       round(user_id / (SELECT stddev_samp(user_id) FROM events), 6) AS user_id_std FROM events"""
)
def standardize(spark, sf):
    out = features.standardize(table(spark, sf, "events"), ["value", "user_id"])
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in ("value_std", "user_id_std")])


@query(
    "WITH "
    + LOAN_VIEW_SQL
    + """,
w AS (SELECT CAST(3 + (count(DISTINCT grade) + 1) + (count(DISTINCT coalesce(loan_status, 'missing')) + 1) AS INTEGER) AS width
      FROM lv)
SELECT loan_id, width, round(coalesce(loan_amnt, 0) + annual_inc + dti + 2, 4) AS total FROM lv, w"""
)
def assemble(spark, sf):
    """One-hot slots add exactly one per category, so the vector sum is known."""
    numeric, categorical = ["loan_amnt", "annual_inc", "dti"], ["grade", "loan_status"]
    rows = loan_view(spark, sf).select("loan_id", *numeric, *categorical)
    full = features.complete_features(rows, numeric, categorical)
    out = features.fit_encoder(full, numeric, categorical).transform(full)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda acc, x: acc + x)
    return out.select(
        "loan_id", F.lit(features.vector_width(out)).alias("width"), F.round(total, 4).alias("total")
    )


@query()
def pca_2d(spark, sf):
    rows = features.array_to_features(table(spark, sf, "embeddings"), "embedding")
    points = vector_to_array("pca")
    return features.pca(rows, k=2).select(
        "vec_id", "label", F.get(points, F.lit(0)).alias("pc1"), F.get(points, F.lit(1)).alias("pc2")
    )
