"""Column profiles as stored states that merge without reading their rows again.

A state is one row per part and column: counts, ends, mean and centred squares, a HyperLogLog
sketch of the values and a KLL sketch of their order.  Counts, ends and moments of merged states
are those of all rows; distinct values and quantiles are estimates whose error does not grow with
the number of parts.  Exact values come from ``profile.numeric_summary`` on request.

NULL and NaN are missing values and counted apart; infinite values count as values, and a column
that has one has no finite mean or deviation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.profile import numeric_columns
from strata.operators.quantiles import clean_value
from strata.runtime import as_list

#: log2 of the registers: a standard error of 1.04 / sqrt(2^12), 1.6 %.
DISTINCT_BITS = 12
#: Size of the order sketch: a rank error of about 0.7 %.
ORDER_SIZE = 400


def states(df: DataFrame, cols: str | Sequence[str] | None = None, part: str | Column | None = None) -> DataFrame:
    """(part, column, n_rows, n_null, n_nan, n, low, high, mean, squares, distinct, order) per part and column.

    One pass over all columns: a task keeps a state per part that it sees.
    """
    cols = as_list(cols) if cols else numeric_columns(df)
    key = F.lit("all") if part is None else (F.col(part) if isinstance(part, str) else part).cast("string")
    rows = []
    for c in cols:
        raw, v = F.col(c).cast("double"), clean_value(df, c)
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(raw.isNull()).alias("n_null"),
                F.count_if(raw.isNotNull() & v.isNull()).alias("n_nan"),
                F.count(v).alias("n"),
                F.min(v).alias("low"),
                F.max(v).alias("high"),
                F.avg(v).alias("mean"),
                (F.var_pop(v) * F.count(v)).alias("squares"),
                F.hll_sketch_agg((v + F.lit(0.0)).cast("string"), DISTINCT_BITS).alias("distinct"),
                F.kll_sketch_agg_double(v, ORDER_SIZE).alias("order"),
            )
        )
    return df.groupBy(key.alias("part")).agg(F.array(*rows).alias("rows")).select("part", F.inline("rows"))


def merged(states: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """One state per column (and value of ``by``) from the states of any parts; stored states are never rescanned."""
    keys = [*as_list(by), "column"]
    known = states.filter("n > 0")
    sums = states.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_nan", "n")], F.min("low").alias("low"), F.max("high").alias("high")
    )
    group = Window.partitionBy(*keys)  # a row per part, never a row of data
    apart = known.withColumn("__mean", F.sum(F.col("mean") * F.col("n")).over(group) / F.sum("n").over(group))
    spread = apart.groupBy(*keys).agg(
        F.any_value("__mean").alias("mean"),
        F.sum(F.col("squares") + F.col("n") * (F.col("mean") - F.col("__mean")) * (F.col("mean") - F.col("__mean"))).alias("squares"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("order").alias("order"),
    )
    both = sums.join(spread.toDF(*[f"__{k}" for k in keys], "mean", "squares", "distinct", "order"), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left")
    return both.select(*keys, "n_rows", "n_null", "n_nan", "n", "low", "high", "mean", "squares", "distinct", "order")


def summary(states: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), by: str | Sequence[str] = ()) -> DataFrame:
    """What merged states say: exact counts, ends, mean and deviation; estimated distinct values and quantiles."""
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    at = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("order", ranks))
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    return states.select(
        *as_list(by),
        "column",
        "n_rows",
        "n_null",
        "n_nan",
        "low",
        "high",
        "mean",
        deviation.alias("stddev"),
        F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0)).alias("n_distinct"),
        *[F.get(at, F.lit(i)).alias(f"q{int(round(100 * q))}") for i, q in enumerate(quantiles)],
    )
