"""Plain forms of some operators, as a yardstick for bench.py.

One job per column, windows over whole strata, metrics from a full single-task sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.plans.catalog.profiling import LINE_NUMBERS
from strata.plans.loan_view import loan_view, table


def quantiles_exact(spark, sf):
    """Exact percentile aggregate, one job per column."""
    lines = table(spark, sf, "lineitem")
    points = F.array(*[F.lit(p) for p in (0.01, 0.25, 0.5, 0.75, 0.99)])
    rows = [(c, lines.agg(F.percentile(c, points)).first()[0]) for c in LINE_NUMBERS]
    return spark.createDataFrame(rows, "c string, q array<double>")


def numeric_summary(spark, sf):
    """One six-number aggregate per column."""
    lines = table(spark, sf, "lineitem")
    rows = []
    for c in [*LINE_NUMBERS, "l_linenumber"]:
        rows.append(
            lines.agg(
                F.count_distinct(c), F.min(c).cast("double"), F.percentile(c, 0.5), F.avg(c), F.stddev(c),
                F.max(c).cast("double"),
            ).first()
        )
    return spark.createDataFrame([tuple(r) for r in rows], "d long, a double, b double, c double, e double, f double")


def frequency_all(spark, sf):
    """One group-by job per column."""
    lv = loan_view(spark, sf)
    cols = ["grade", "loan_status", "home_ownership", "int_rate"]
    rows = [(c, r[0], r[1]) for c in cols for r in lv.groupBy(c).count().collect()]
    return spark.createDataFrame(rows, "c string, v string, n long")


def stratified_kfolds_lines(spark, sf):
    """One window per stratum: the hot stratum is a single task."""
    lines = table(spark, sf, "lineitem")
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    order = Window.partitionBy("l_returnflag").orderBy(F.md5(F.concat_ws(":", F.lit("1"), *key)), *key)
    return lines.withColumn("fold", (F.row_number().over(order) - 1) % 3)


def ranking_metrics_continuous(spark, sf):
    """One global window over all rows."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("score"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y")
    )
    order = Window.orderBy(F.desc("score"))
    curve = lines.withColumn("tp", F.sum("y").over(order)).withColumn("k", F.count(F.lit(1)).over(order))
    total = lines.agg(F.sum("y")).first()[0]
    return curve.agg(F.sum(F.col("y") * F.col("tp") / F.col("k")) / total)


NAIVE = {
    f.__name__: f
    for f in (
        quantiles_exact, numeric_summary, frequency_all, stratified_kfolds_lines, ranking_metrics_continuous,
    )
}
