"""Running totals over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.runtime import pin


def bucket_index(df: DataFrame, value: str, bounds: Column, n_bounds: int, out: str) -> DataFrame:
    """Add ``out`` = number of ``bounds`` (an ascending array) below ``value``, by halving.

    ``n_bounds`` must be one less than a power of two.  Each halving is its own projection,
    so the lookups stay inside generated code and are never written out twice; the array is
    a column of the first one, so a subquery behind it runs once.
    """
    step = (n_bounds + 1) // 2
    df = df.withColumns({"__bounds": bounds, out: F.lit(0)})
    while step >= 1:
        pos = F.col(out)
        above = F.col(value) > F.get("__bounds", pos + F.lit(step - 1))
        df = df.withColumn(out, F.when(above, pos + F.lit(step)).otherwise(pos))
        step //= 2
    return df.drop("__bounds")


def default_buckets(spark: SparkSession) -> int:
    """A power of two, about twice the session's shuffle partitions: more on a larger cluster."""
    wanted = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1 << (wanted - 1).bit_length(), 16)


def row_numbers(df: DataFrame, order: Sequence[str], out: str = "rank") -> DataFrame:
    """Add the 0-based number of each row along ``order``, whose columns must tell rows apart.

    Rows go to ranges of ``order``; the rows of the ranges before (one count per range) and
    the place inside the range add up to the number.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = pin(df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy(F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__range").orderBy(*order)
    return (
        ranges.join(F.broadcast(offsets), F.col("__range") == F.col("__r"))  # one row per shuffle partition
        .withColumn(out, F.col("__before") + F.row_number().over(inside) - 1)
        .select(*df.columns, out)
    )


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
    prefix: str = "cum_",
) -> DataFrame:
    """Inclusive running sum of each of ``sums`` along ``order``, per group of ``by``.

    ``df`` must have one row per (by, order) value, as a group-by leaves it, so that no
    value is hot.  Rows are cut into ``buckets`` value ranges at sketch quantiles of
    ``order``; totals of the buckets before a row come from a small table, the rest from a
    window inside the bucket.  The sketch only balances the work: any boundaries give the
    same sums.  ``buckets`` must be a power of two.
    """
    by = list(by)
    buckets = buckets or default_buckets(df.sparkSession)
    n_bounds = buckets - 1
    points = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(order, points, max(1000, 4 * buckets))).scalar()
    cut = bucket_index(df, order, bounds, n_bounds, "__bucket")
    if descending:
        cut = cut.withColumn("__bucket", F.lit(n_bounds) - F.col("__bucket"))

    keys = [*by, "__bucket"]
    totals = cut.groupBy(*keys).agg(*[F.sum(s).alias(f"__t_{s}") for s in sums])
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"__t_{s}").over(before), F.lit(0)).alias(f"__o_{s}") for s in sums],
    )
    same_bucket = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in by]
    same_bucket.append(F.col("__bucket") == F.col("__k___bucket"))

    direction = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*keys).orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.join(offsets, same_bucket)
        .withColumns({f"{prefix}{s}": F.col(f"__o_{s}") + F.sum(s).over(inside) for s in sums})
        .select(*df.columns, *[f"{prefix}{s}" for s in sums])
    )
