"""Distribution drift between two frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.prefix import running_totals
from strata.operators.quantiles import clean_value, quantile_map
from strata.runtime import as_list


def psi(
    base: DataFrame,
    current: DataFrame,
    cols: str | Sequence[str],
    bins: int = 10,
    accuracy: int | None = None,
    epsilon: float = 1e-6,
) -> DataFrame:
    """(column, psi): population stability index over quantile bins of ``base``.

    NULL forms a bin of its own.  A share of 0 counts as ``epsilon``.
    """
    cols = as_list(cols)
    edges = quantile_map(base, cols, [i / bins for i in range(1, bins)], accuracy)

    def binned(df: DataFrame, which: str) -> DataFrame:
        index = {}
        for c in cols:
            v = clean_value(df, c)
            above = [F.when(v > e, 1).otherwise(0) for e in edges[c] if e is not None]
            index[c] = F.when(v.isNotNull(), sum(above, F.lit(0))).otherwise(-1)
        return (
            df.select(*[index[c].alias(c) for c in cols])
            .unpivot([], cols, "column", "bin")
            .groupBy("column", "bin")
            .agg(F.count(F.lit(1)).alias(which))
        )

    counts = binned(base, "b").join(binned(current, "c"), ["column", "bin"], "full")
    totals = {w: df.agg(F.count(F.lit(1)).cast("double")).scalar() for w, df in (("b", base), ("c", current))}
    share = lambda w: F.try_divide(F.coalesce(w, F.lit(0)).cast("double"), totals[w])
    p, q = (F.greatest(share(w), F.lit(epsilon)) for w in ("b", "c"))
    return counts.groupBy("column").agg(F.sum((p - q) * F.log(p / q)).alias("psi"))


def ks(base: DataFrame, current: DataFrame, cols: str | Sequence[str], buckets: int | None = None) -> DataFrame:
    """(column, ks): largest distance between the two empirical distribution functions; NULL and NaN are missing."""
    cols = as_list(cols)

    def long(df: DataFrame, in_base: int) -> DataFrame:
        return (
            df.select(*[clean_value(df, c).alias(c) for c in cols])
            .unpivot([], cols, "column", "value")
            .filter(F.col("value").isNotNull())
            .withColumn("in_base", F.lit(in_base))
        )

    counts = (
        long(base, 1)
        .unionByName(long(current, 0))
        .groupBy("column", "value")
        .agg(F.count_if(F.col("in_base") == 1).alias("b"), F.count_if(F.col("in_base") == 0).alias("c"))
    )
    curve = running_totals(counts, "value", ["b", "c"], by=["column"], buckets=buckets)
    # Gap of the two step functions, put over the common denominator n_b * n_c.
    totals = counts.groupBy(F.col("column").alias("__col")).agg(
        F.sum("b").cast("double").alias("nb"), F.sum("c").cast("double").alias("nc")
    )
    gap = F.abs(F.try_divide(F.col("cum_b"), F.col("nb")) - F.try_divide(F.col("cum_c"), F.col("nc")))
    return (
        curve.join(totals, F.col("column") == F.col("__col"))
        .groupBy("column")
        .agg(F.max(gap).alias("ks"))
    )
