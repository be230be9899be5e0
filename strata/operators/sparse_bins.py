"""Histograms and densities over occupied bins only.

A bin is named by its 64-bit number along an even grid, and only bins that hold a row exist.  So
one far value costs one bin, not the millions of empty ones up to it, and a density is summed up
over the neighbours of occupied bins instead of over every bin for every point.

NULL and NaN are missing values.  Infinite values belong to no bin; where there are any, they are
counted in rows without a bin number whose edges are both that infinity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.quantiles import clean_value, quantile_map

#: Bin numbers stay below this, so that neighbouring bins have different edges as doubles.
MOST_BINS = 1 << 50


def finite_value(df: DataFrame, col: str) -> Column:
    """The column as DOUBLE, NULL in place of NaN and of infinite values."""
    v = clean_value(df, col)
    return F.when(F.abs(v) < F.lit(float("inf")), v)


@dataclass(frozen=True)
class Spread:
    """Finite values of a column: their number, ends, sample deviation and quartile distance."""

    n: int
    low: float | None
    high: float | None
    deviation: float | None
    quartiles: float

    @classmethod
    def of(cls, df: DataFrame, col: str, accuracy: int | None = None) -> Spread:
        rows = df.select(finite_value(df, col).alias("v"))
        q1, q3 = quantile_map(rows, ["v"], [0.25, 0.75], accuracy)["v"]
        n, low, high, deviation = rows.agg(F.count("v"), F.min("v"), F.max("v"), F.stddev_samp("v")).first()
        return cls(n, low, high, deviation, (q3 or 0.0) - (q1 or 0.0))

    def bins(self) -> int:
        """Bins of the finer of the Sturges and Freedman-Diaconis widths; 1 for a constant column."""
        if not self.n or self.high == self.low:
            return 1
        import math

        span = self.high - self.low
        widths = [span / (math.log2(self.n) + 1), 2 * self.quartiles / math.cbrt(self.n)]
        return min(MOST_BINS, max(1, math.ceil(span / min(w for w in widths if w > 0))))

    def bandwidth(self) -> float:
        """Silverman's rule, which a few far values do not widen; at least 2^-50 of the range."""
        spreads = [s for s in (self.deviation, self.quartiles / 1.349) if s]
        if not spreads or self.n < 2:
            return 0.0
        return max(0.9 * min(spreads) * self.n**-0.2, (self.high - self.low) / MOST_BINS)


def _infinite(df: DataFrame, col: str) -> DataFrame:
    v = clean_value(df, col)
    far = df.select(v.alias("low")).filter(F.abs("low") == F.lit(float("inf")))
    counted = far.groupBy("low").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.lit(None).cast("long").alias("bin"), "low", F.col("low").alias("high"), "n")


def histogram(df: DataFrame, col: str, bins: int | str = "auto", accuracy: int | None = None) -> DataFrame:
    """(bin, low, high, n) of the occupied bins among ``bins`` equal ones over the finite range.

    The result has at most as many rows as the column has different values.
    """
    if bins == "auto":
        spread = Spread.of(df, col, accuracy)
        bins, low, high = spread.bins(), spread.low, spread.high
    else:
        low, high = df.select(finite_value(df, col).alias("v")).agg(F.min("v"), F.max("v")).first()
    if low is None:
        return _infinite(df, col)
    width = (high - low) / bins
    v = finite_value(df, col)
    place = F.least(F.floor((v - F.lit(low)) / F.lit(width)), F.lit(bins - 1).cast("long")) if width else F.lit(0).cast("long")
    counts = df.filter(v.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edge = lambda k: F.lit(low) + k * F.lit(width)
    finite = counts.select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), "n")
    return finite.unionByName(_infinite(df, col))


def density(
    df: DataFrame, col: str, bandwidth: float | None = None, cells: int = 8, reach: int = 4, accuracy: int | None = None
) -> DataFrame:
    """(point, x, density): Gaussian kernel density every half bandwidth, where it is not negligible.

    Rows are counted into occupied cells of a ``cells``-th of the bandwidth; a cell adds to the
    points within ``reach`` bandwidths of its centre, 4 ``reach`` + 1 at most, so the cost is in
    proportion to the occupied cells.  Points that no cell reaches have less than
    exp(-reach^2 / 2) of a lone row's peak and are left out.  The bandwidth is Silverman's;
    a column without any spread has no density and gives no rows.
    """
    spread = Spread.of(df, col, accuracy)
    h = bandwidth or spread.bandwidth()
    if not h:
        return df.sparkSession.createDataFrame([], "point long, x double, density double")
    low, cell, step = spread.low, h / cells, h / 2
    v = finite_value(df, col)
    held = df.filter(v.isNotNull()).groupBy(F.floor((v - F.lit(low)) / F.lit(cell)).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    # centre of the cell, in steps from the lowest value
    centre = (F.col("cell") + F.lit(0.5)) * F.lit(cell / step)
    points = F.sequence(F.ceil(centre - 2 * reach), F.floor(centre + 2 * reach))
    z = (F.col("point") - F.col("centre")) * F.lit(step / h)
    return (
        held.select("n", centre.alias("centre"), F.explode(points).alias("point"))
        .groupBy("point")
        .agg(F.sum(F.col("n") * F.exp(F.lit(-0.5) * z * z)).alias("mass"))
        .select(
            "point",
            (F.lit(low) + F.col("point") * F.lit(step)).alias("x"),
            (F.col("mass") / (F.lit(spread.n * h) * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
        )
    )
