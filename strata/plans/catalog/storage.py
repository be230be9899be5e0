"""Sources and sinks: whole tables out and back in again."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import profile
from strata.operators.evaluate import runs_table
from strata.plans.catalog.profiling import _NULLS_SQL
from strata.plans.catalog.registry import query
from strata.plans.loan_view import loan_view, table
from strata.runtime import scratch_path
from strata.sources import append_metrics, drop_if_present, read_metrics, read_table, resolve_source, write_table

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"
_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate date, o_orderpriority string"
)


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


@query(_ORDERS)
def csv_parts(spark, sf):
    """Many CSV files with a declared schema; the part files win over an archive."""
    path = scratch_path(spark, "orders-csv")
    write_table(_orders(spark, sf), path, format="csv", files=4, max_records=2_000)
    return read_table(spark, resolve_source(spark, f"{path}/part-*.csv", [], min_parts=1), _SCHEMA, format="csv")


@query(_ORDERS)
def csv_gzip(spark, sf):
    """A gzip archive read as text, an unnamed index column dropped, values parsed afterwards."""
    path = scratch_path(spark, "orders-gz")
    write_table(
        _orders(spark, sf).withColumn("_c0", F.col("o_orderkey")), path, format="csv", files=4, max_records=2_000, compression="gzip"
    )
    files = resolve_source(spark, f"{path}/absent-*.csv", [f"{path}/none.gz", f"{path}/part-*.csv.gz"])
    raw = drop_if_present(read_table(spark, files, format="csv", partitions=8), ["_c0"])
    return raw.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").try_cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
        F.try_to_date("o_orderdate").alias("o_orderdate"),
        "o_orderpriority",
    )


@query(_ORDERS)
def parquet_bounded_files(spark, sf):
    path = scratch_path(spark, "orders-parquet")
    write_table(_orders(spark, sf), path, files=4, max_records=250_000)
    return read_table(spark, path)


@query(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'"
)
def parquet_scan(spark, sf):
    """Both filters reach the scan, and three of six columns are read."""
    return (
        table(spark, sf, "orders")
        .filter((F.col("o_totalprice") > 100_000) & (F.col("o_orderstatus") == "F"))
        .select("o_orderkey", "o_totalprice")
    )


def _logged(spark, sf):
    nulls = profile.null_profile(loan_view(spark, sf))
    rows = nulls.unpivot(["column"], ["n_null", "pct_null"], "metric", "value")
    metrics = rows.select(F.col("column").alias("run_id"), "metric", F.round("value", 6).alias("value"))
    path = scratch_path(spark, "metrics")
    append_metrics(metrics.filter("metric = 'n_null'"), "count", path)
    append_metrics(metrics.filter("metric = 'pct_null'"), "share", path)
    return read_metrics(spark, path)


@query(
    _NULLS_SQL
    + """
SELECT "column" AS run_id, 'count' AS step, 'n_null' AS metric, CAST(n_null AS DOUBLE) AS value FROM np
UNION ALL SELECT "column", 'share', 'pct_null', pct_null FROM np"""
)
def metrics_log(spark, sf):
    return _logged(spark, sf).select("run_id", "step", "metric", "value")


@query(
    _NULLS_SQL + '\nSELECT "column" AS run_id, CAST(n_null AS DOUBLE) AS n_null, pct_null FROM np'
)
def runs_from_log(spark, sf):
    return runs_table(_logged(spark, sf), ["n_null", "pct_null"])
