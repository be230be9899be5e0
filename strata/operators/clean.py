"""Cleaning: typed columns, missing values, clipping, category collapse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from strata.functions import parse, text
from strata.operators.quantiles import clean_value, quantile_map
from strata.runtime import as_list, attach, pin


def percent_to_double(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return df.withColumns({c: parse.percent_to_double(c) for c in as_list(cols)})


def to_double(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return df.withColumns({c: parse.to_double(c) for c in as_list(cols)})


def drop_nulls(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Keep rows with a value (neither NULL nor NaN) in every one of ``cols``."""
    return df.na.drop(subset=as_list(cols))


def fill_constant(df: DataFrame, value: str | float, cols: str | Sequence[str]) -> DataFrame:
    """Replace NULL (and NaN in numbers); a column of the other kind is an error, not skipped.

    Numbers come out as DOUBLE, since filling 2.7 into an INT column would store 2.
    """
    new = {}
    for c in as_list(cols):
        dtype = df.schema[c].dataType
        if isinstance(value, str):
            if not isinstance(dtype, StringType):
                raise TypeError(f"cannot fill {c} ({dtype.simpleString()}) with text")
            new[c] = F.coalesce(c, F.lit(value))
        else:
            if not isinstance(dtype, NumericType):
                raise TypeError(f"cannot fill {c} ({dtype.simpleString()}) with a number")
            new[c] = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(float(value)))
    return df.withColumns(new)


def sentinel_to_null(df: DataFrame, sentinels: Mapping[str, float | str]) -> DataFrame:
    """Turn an error marker into NULL, one marker per column."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in sentinels.items()})


def impute_median(
    df: DataFrame,
    cols: str | Sequence[str],
    accuracy: int | None = None,
    medians: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """Fill NULL and NaN with the column's median; an all-NULL column is left alone.

    Pass the ``medians`` learned on the training rows to treat other rows alike.
    """
    cols = as_list(cols)
    if medians is None:
        medians = {c: v[0] for c, v in quantile_map(df, cols, [0.5], accuracy).items()}
    known = {c: medians[c] for c in cols if medians.get(c) is not None}
    return df.withColumns({c: F.coalesce(clean_value(df, c), F.lit(v)) for c, v in known.items()})


def winsorize(
    df: DataFrame,
    cols: str | Sequence[str],
    lower: float = 0.01,
    upper: float = 0.99,
    accuracy: int | None = None,
    bounds: Mapping[str, Sequence[float | None]] | None = None,
) -> DataFrame:
    """Clip each column to its [lower, upper] quantiles; NULL stays NULL and NaN stays NaN."""
    cols = as_list(cols)
    if bounds is None:
        bounds = quantile_map(df, cols, [lower, upper], accuracy)
    new = {}
    for c in cols:
        low, high = bounds[c]
        if low is not None:
            v = F.col(c).cast("double")
            new[c] = F.when(F.isnan(v), v).when(v < low, F.lit(low)).when(v > high, F.lit(high)).otherwise(v)
    return df.withColumns(new)


def normalize_text(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.fold_text(c) for c in as_list(cols)})


def top_values(df: DataFrame, cols: str | Sequence[str], k: int) -> DataFrame:
    """(column, value, n, rank): the k most frequent values per column, ties by value.

    All columns are counted in one aggregate.  NULL never takes a place.
    """
    cols = as_list(cols)
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        .unpivot([], cols, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Only distinct values reach this window, and the rank limit is applied before its shuffle.
    by_count = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= k)


def top_k_categories(
    df: DataFrame, cols: str | Sequence[str], k: int = 100, other: str = "other"
) -> DataFrame:
    """Keep the k most frequent values of each column; everything else becomes ``other``."""
    cols = as_list(cols)
    kept = pin(top_values(df, cols, k).select("column", "value", F.col("n").alias("__n")))
    out = df
    for c in cols:
        mine = kept.filter(F.col("column") == c).select(
            F.col("value").alias(c), F.col("value").alias("__kept"), "__n"
        )
        # k rows at most, of any length: measured, and heavy values joined apart where they are too large
        out = attach(out, mine, c, "__n")
        out = out.withColumn(c, F.coalesce("__kept", F.lit(other))).drop("__kept", "__n")
    return out.select(*df.columns)
