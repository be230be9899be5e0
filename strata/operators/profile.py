"""Column profiles.  Each report is one or two aggregates over all columns at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from strata.operators import comoments, sparse_bins
from strata.operators.quantiles import clean_value, quantile_map
from strata.runtime import as_list

EXPRESSIONS_PER_PASS = 200
#: An automatic histogram lays out its empty bins up to this number.
GRID_BINS = 10_000


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _per_column(df: DataFrame, stats: dict[str, dict[str, Column]], name: str = "column") -> DataFrame:
    """Evaluate, for every column, the same named aggregates; result in long form.

    The aggregate has no key: each task keeps one buffer row, and a single row is merged.
    """
    parts = []
    names = list(stats)
    for i in range(0, len(names), EXPRESSIONS_PER_PASS):
        chunk = names[i : i + EXPRESSIONS_PER_PASS]
        rows = [
            F.struct(F.lit(c).alias(name), *[e.alias(k) for k, e in stats[c].items()]) for c in chunk
        ]
        parts.append(df.agg(F.array(*rows).alias("rows")).select(F.inline("rows")))
    return reduce(DataFrame.unionAll, parts)


def _nan_count(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return F.count_if(F.isnan(c))
    return F.lit(0).cast("long")


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def frequency(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Rows per value (or combination), most frequent first, ties by value."""
    cols = as_list(cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *cols)


def frequency_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) for all columns in one job."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in cols])
        .unpivot([], list(cols), "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def pct_of_total(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Rows per stratum and their percentage of all rows, two decimals."""
    counts = df.groupBy(*as_list(cols)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n").cast("double") / total * F.lit(100.0), 2))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, n_null, n_nan, pct_null) for every column."""
    stats = {
        c: {
            "n_null": F.count_if(F.col(c).isNull()),
            "n_nan": _nan_count(df, c),
            "pct_null": F.try_divide(
                F.count_if(F.col(c).isNull()).cast("double") * 100, F.count(F.lit(1)).cast("double")
            ),
        }
        for c in df.columns
    }
    return _per_column(df, stats)


def missing_pct(df: DataFrame) -> DataFrame:
    """One row: percentage of NULL cells among all cells."""
    nulls = reduce(Column.__add__, [F.count_if(F.col(c).isNull()) for c in df.columns])
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(F.try_divide(nulls.cast("double") * 100, cells.cast("double")).alias("missing_pct"))


def top_missing(df: DataFrame, n: int = 5) -> DataFrame:
    return null_profile(df).orderBy(F.desc("n_null"), "column").limit(n)


def scalar_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, avg, min, max), NULL and NaN ignored."""
    stats = {}
    for c in cols:
        v = clean_value(df, c)
        stats[c] = {"avg": F.avg(v), "min": F.min(v), "max": F.max(v)}
    return _per_column(df, stats)


def _exact_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values per column by a two-step group-by: no wide multi-distinct expansion.

    Values meet as text, which tells all values of integer and decimal columns apart;
    floating point is cleaned first, so 0.0 and -0.0 are one value and NaN is none.
    """
    float_like = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    text = lambda c: (clean_value(df, c) + F.lit(0.0) if c in float_like else F.col(c)).cast("string")
    return (
        df.select(*[text(c).alias(c) for c in cols])
        .unpivot([], list(cols), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )


def numeric_summary(
    df: DataFrame, cols: Sequence[str] | None = None, accuracy: int | None = None, exact_distinct: bool = True
) -> DataFrame:
    """(column, n_distinct, min, median, mean, stddev, max) per numeric column."""
    cols = as_list(cols) if cols else numeric_columns(df)
    medians = quantile_map(df, cols, [0.5], accuracy)
    stats = {}
    for c in cols:
        v = clean_value(df, c)
        stats[c] = {
            "n_distinct": F.approx_count_distinct(v),
            "min": F.min(v),
            "median": F.lit(medians[c][0]).cast("double"),
            "mean": F.avg(v),
            "stddev": F.stddev_samp(v),
            "max": F.max(v),
        }
        if exact_distinct:
            del stats[c]["n_distinct"]
    table = _per_column(df, stats)
    if exact_distinct:
        table = table.join(_exact_distinct(df, cols), "column", "left").withColumn(
            "n_distinct", F.coalesce("n_distinct", F.lit(0).cast("long"))
        )
    return table.select("column", "n_distinct", "min", "median", "mean", "stddev", "max")


def iqr_outliers(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    k: float = 1.5,
    top: int | None = 10,
    accuracy: int | None = None,
) -> DataFrame:
    """Quartiles, spread and rows outside [q1 - k*IQR, q3 + k*IQR]; most outliers first."""
    cols = as_list(cols) if cols else numeric_columns(df)
    quartiles = quantile_map(df, cols, [0.25, 0.5, 0.75], accuracy)
    stats = {}
    for c in cols:
        q1, q2, q3 = quartiles[c]
        v = clean_value(df, c)
        outside = F.lit(0).cast("long")
        if q1 is not None:
            reach = k * (q3 - q1)
            outside = F.count_if((v < q1 - reach) | (v > q3 + reach))
        stats[c] = {
            "q1": F.lit(q1).cast("double"),
            "q2": F.lit(q2).cast("double"),
            "q3": F.lit(q3).cast("double"),
            "stddev": F.stddev_samp(v),
            "n_outliers": outside,
            "pct_outliers": F.try_divide(outside.cast("double") * 100, F.count(F.lit(1)).cast("double")),
        }
    table = _per_column(df, stats).orderBy(F.desc("n_outliers"), "column")
    return table.limit(top) if top else table


def tail_outliers(
    df: DataFrame, cols: Sequence[str], lower: float = 0.01, upper: float = 0.99, accuracy: int | None = None
) -> DataFrame:
    """(column, low, high, n_outliers): rows below the lower or above the upper quantile."""
    ends = quantile_map(df, cols, [lower, upper], accuracy)
    stats = {}
    for c in cols:
        low, high = ends[c]
        v = clean_value(df, c)
        outside = F.lit(0).cast("long") if low is None else F.count_if((v < low) | (v > high))
        stats[c] = {
            "low": F.lit(low).cast("double"),
            "high": F.lit(high).cast("double"),
            "n_outliers": outside,
        }
    return _per_column(df, stats)


def _pearson(x: Column, y: Column) -> Column:
    """Pearson r over rows where both are present; NULL when either is constant or infinite there.

    Built from moments because ``corr`` divides by zero on a constant column in ANSI mode.
    """
    spread = F.sqrt(F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y)))
    return F.nanvl(F.try_divide(F.covar_pop(x, y), spread), F.lit(None).cast("double"))


def correlation(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(a, b, r): Pearson correlation of every ordered pair, rows with a NULL or NaN dropped pairwise.

    Few columns are one aggregate of generated code; more than ``EXPRESSIONS_PER_PASS`` pairs go
    to the tiled co-moments of ``comoments``, which read a table of any width once.
    """
    cols = as_list(cols) if cols else numeric_columns(df)
    pairs = [*combinations(cols, 2), *[(c, c) for c in cols]]
    if len(pairs) > EXPRESSIONS_PER_PASS:
        return comoments.correlations(df, cols).select("a", "b", "r")
    rows = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), _pearson(clean_value(df, a), clean_value(df, b)).alias("r"))
        for a, b in pairs
    ]
    half = df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "r"))).otherwise(
        F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    )
    return half.select(F.inline(both))


def auto_bins(df: DataFrame, col: str, accuracy: int | None = None) -> int:
    """Bin count from the finer of the Sturges and Freedman-Diaconis widths, over the finite values."""
    return sparse_bins.Spread.of(df, col, accuracy).bins()


def histogram(df: DataFrame, col: str, bins: int | str = 20) -> DataFrame:
    """(bin, low, high, n): equal-width bins over the finite range, empty bins included.

    ``bins="auto"`` picks the number from the data; more than ``GRID_BINS`` of them are not laid
    out, the occupied ones are returned then.  NULL and NaN are missing; infinite values, where
    there are any, are counted in rows with a NULL bin whose edges are both that infinity.
    """
    if bins == "auto":
        bins = auto_bins(df, col)
        if bins > GRID_BINS:
            return sparse_bins.histogram(df, col, bins)
    v = clean_value(df, col)
    finite = sparse_bins.finite_value(df, col)
    far = F.abs(v) == F.lit(float("inf"))
    ends = df.agg(F.struct(F.min(finite).alias("lo"), F.max(finite).alias("hi"))).scalar()
    lo = ends.getField("lo")
    width = (ends.getField("hi") - lo) / F.lit(float(bins))
    # A constant column has width 0 and falls into the first bin; ``least`` would skip the NULL.
    place = F.coalesce(F.floor(F.try_divide(finite - lo, width)), F.lit(0).cast("long"))
    index = F.when(far, F.when(v > 0, bins).otherwise(-1)).otherwise(F.least(place, F.lit(bins - 1).cast("long")))
    counts = (
        df.filter(v.isNotNull())
        .select(index.alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.range(-1, bins + 1).withColumnRenamed("id", "bin")
    inner = F.col("bin").between(0, bins - 1)
    side = F.when(F.col("bin") < 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        grid.join(counts, "bin", "left")
        .filter(inner | F.col("n").isNotNull())
        .select(
            F.when(inner, F.col("bin")).cast("int").alias("bin"),
            F.when(inner, lo + F.col("bin") * width).otherwise(side).alias("low"),
            F.when(inner, lo + (F.col("bin") + 1) * width).otherwise(side).alias("high"),
            F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        )
    )


def density(df: DataFrame, col: str, points: int = 50, bins: int = 200, bandwidth: float | None = None) -> DataFrame:
    """(point, x, density): Gaussian kernel density on an even grid over the finite range.

    Rows are first counted into ``bins`` narrow bins; the kernel runs over bin centres, so
    its cost is bins x points whatever the table size.  The default bandwidth is Scott's,
    ``stddev * n ** (-1/5)``.  With values far from the rest, take ``sparse_bins.density``.
    """
    v = sparse_bins.finite_value(df, col)
    stats = df.agg(
        F.struct(
            F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"), F.stddev_samp(v).alias("sd")
        )
    ).scalar()
    n = stats.getField("n").cast("double")
    h = F.lit(bandwidth) if bandwidth else stats.getField("sd") * F.pow(n, F.lit(-0.2))
    lo, hi = stats.getField("lo"), stats.getField("hi")
    point = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    centre = (F.col("low") + F.col("high")) / 2
    return (
        histogram(df, col, bins)
        .filter((F.col("n") > 0) & F.col("bin").isNotNull())
        .select(centre.alias("centre"), "n", point.alias("point"))
        .withColumn("x", lo + F.col("point") * (hi - lo) / F.lit(float(points - 1)))
        .withColumn("z", F.try_divide(F.col("x") - F.col("centre"), h))
        .groupBy("point", "x")
        .agg(F.sum(F.col("n") * F.exp(F.lit(-0.5) * F.col("z") * F.col("z"))).alias("mass"))
        .select("point", "x", F.try_divide(F.col("mass"), n * h * F.sqrt(F.lit(2.0) * F.pi())).alias("density"))
    )


def null_rate_by(df: DataFrame, group: str | Column, cols: Sequence[str], name: str = "group") -> DataFrame:
    """(group, column, n_rows, pct_null): how completely each column is filled per group."""
    key = F.col(group) if isinstance(group, str) else group
    rates = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("n_rows"),
            (F.count_if(F.col(c).isNull()).cast("double") * 100 / F.count(F.lit(1))).alias("pct_null"),
        )
        for c in cols
    ]
    return df.groupBy(key.alias(name)).agg(F.array(*rates).alias("rates")).select(name, F.inline("rates"))
