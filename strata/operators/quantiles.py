"""Quantiles of many columns: a sketch in one pass, or exact by narrowing."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from strata.operators.radix import values_at
from strata.runtime import as_list

#: Rows of an interval that are ranked by one window; larger intervals are narrowed by counts.
DIRECT_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000
COLUMNS_PER_PASS = 50

_RESULT = "`column` string, p double, quantile double"


def clean_value(df: DataFrame, c: str) -> Column:
    """The column as DOUBLE, NULL in place of NaN: both are missing values to every statistic."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v) if isinstance(df.schema[c].dataType, (DoubleType, FloatType)) else v


def _sketch(df: DataFrame, cols: Sequence[str], points: Sequence[float], accuracy: int) -> dict:
    out: dict = {}
    for i in range(0, len(cols), COLUMNS_PER_PASS):
        part = cols[i : i + COLUMNS_PER_PASS]
        row = df.agg(
            *[
                F.struct(
                    F.count(c).alias("n"),
                    F.percentile_approx(c, list(points), accuracy).alias("at"),
                ).alias(f"c{j}")
                for j, c in enumerate(part)
            ]
        ).first()
        out.update({c: (row[j]["n"], row[j]["at"]) for j, c in enumerate(part)})
    return out


def _ranks(n: int, p: float, interpolate: bool) -> tuple[int, int, float]:
    """0-based ranks below and above the quantile, and the weight of the upper one."""
    if not interpolate:
        r = max(math.ceil(n * p) - 1, 0)
        return r, r, 0.0
    at = (n - 1) * p
    low = math.floor(at)
    return low, min(low + 1, n - 1), at - low


def _locate(v: Column, bounds: Sequence[float], leaf: Callable[[int], Column]) -> Column:
    """Where a value stands among ascending ``bounds``, as a decision tree.

    Position 2i is the open interval below ``bounds[i]``, 2i + 1 the bound itself.  A value
    is compared about log2(bounds) times and the generated code stays small.
    """

    def node(lo: int, hi: int) -> Column:
        if lo == hi:
            return leaf(2 * lo)
        mid = (lo + hi) // 2
        below, above = node(lo, mid), node(mid + 1, hi)
        return F.when(v < bounds[mid], below).when(v > bounds[mid], above).otherwise(leaf(2 * mid + 1))

    return F.when(v.isNotNull(), node(0, len(bounds)))


def _counts_by_position(df: DataFrame, bounds: dict[str, list[float]]) -> dict[str, dict[int, int]]:
    """Rows per column and position among its bounds, in one pass over all columns."""
    cols = list(bounds)
    rows = (
        df.select(*[_locate(F.col(c), bounds[c], F.lit).alias(c) for c in cols])
        .unpivot([], cols, "column", "at")
        .filter(F.col("at").isNotNull())
        .groupBy("column", "at")
        .count()
        .collect()
    )
    out: dict = {c: {} for c in cols}
    for r in rows:
        out[r["column"]][r["at"]] = r["count"]
    return out


def quantiles(
    df: DataFrame,
    cols: str | Sequence[str],
    ps: Sequence[float],
    accuracy: int | None = None,
    interpolate: bool = True,
    method: str = "sketch",
) -> DataFrame:
    """(column, p, quantile) for every column and probability.

    ``accuracy=None`` is exact and works by narrowing rather than by sorting:

    1. one pass sketches, per column, an interval that should hold each wanted rank;
    2. one pass counts the rows at and between the interval ends;
    3. only the rows of the interval that really holds the rank are shuffled, as counts
       per distinct value.  Ranks that hit an interval end need no third pass.  An interval of
       more than ``DIRECT_ROWS`` rows, by the counts of step 2, is narrowed by ``radix`` counts
       instead, so no task gets the interval.

    The counts of step 2 are exact, so a poor sketch makes step 3 larger, never wrong.
    ``method="radix"`` leaves the sketch out: the whole column is the interval.
    What reaches the driver is two counts per interval end.  With an integer the sketch
    itself is the answer (rank error at most 1/accuracy), in one pass.

    ``interpolate`` averages the two neighbouring values; otherwise the value at the
    nearest rank is taken.
    """
    cols = as_list(cols)
    spark = df.sparkSession
    df = df.select(*[clean_value(df, c).alias(c) for c in cols])
    if accuracy is not None:
        found = _sketch(df, cols, ps, accuracy)
        rows = [(c, float(p), found[c][1][i] if found[c][0] else None) for c in cols for i, p in enumerate(ps)]
        return spark.createDataFrame(rows, _RESULT)

    if method == "radix":
        row = df.agg(*[F.count(c) for c in cols]).first()
        found = {c: (row[j], []) for j, c in enumerate(cols)}
        bounds = {c: [] for c in cols}
        counts = {c: {0: found[c][0]} for c in cols}
    else:
        margin = 2.0 / SKETCH_ACCURACY
        points = [q for p in ps for q in (max(p - margin, 0.0), min(p + margin, 1.0))]
        found = _sketch(df, cols, points, SKETCH_ACCURACY)
        bounds = {c: sorted(set(found[c][1])) for c in cols if found[c][0]}
        counts = _counts_by_position(df, bounds) if bounds else {}

    known: list[tuple] = []      # column, p, is_upper, weight, value
    wanted: list[tuple] = []     # column, p, is_upper, weight, interval, rank inside it
    intervals: dict[tuple[str, int], int] = {}
    for c in cols:
        n = found[c][0]
        for p in ps:
            if not n:
                known.append((c, float(p), False, 0.0, None))
                continue
            low, high, weight = _ranks(n, p, interpolate)
            for rank, is_upper in ((low, False), (high, True)):
                side = (c, float(p), is_upper, weight)
                before = 0
                for at in sorted(counts[c]):
                    if rank < before + counts[c][at]:
                        break
                    before += counts[c][at]
                if at % 2:
                    known.append((*side, bounds[c][at // 2]))
                else:
                    where = intervals.setdefault((c, at), len(intervals))
                    wanted.append((*side, where, rank - before))

    large = {i for (c, at), i in intervals.items() if method == "radix" or counts[c][at] > DIRECT_ROWS}
    if large:
        # a row per wanted rank: what the caller asked for
        far = {w: (w[4], w[5]) for w in wanted if w[4] in large}
        known += [(*w[:4], v) for w, v in values_at(_inside(df, bounds, intervals, large), far).items()]
        wanted = [w for w in wanted if w[4] not in large]
    ends = spark.createDataFrame(
        known, "`column` string, p double, is_upper boolean, weight double, value double"
    )
    if wanted:
        near = set(intervals.values()) - large
        ends = ends.unionByName(_pick(df, bounds, intervals, wanted, near))
    at = lambda upper: F.max(F.when(F.col("is_upper") == upper, F.col("value")))
    return (
        ends.groupBy("column", "p")
        .agg(at(False).alias("a"), at(True).alias("b"), F.max("weight").alias("w"))
        .select("column", "p", 
            # without a weight, or between equal ends, no difference is taken: infinity minus infinity is NaN
            F.when((F.col("w") == 0) | F.col("b").isNull() | (F.col("a") == F.col("b")), F.col("a"))
            .otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("w"))
            .alias("quantile"),
        )
    )


def _inside(df: DataFrame, bounds: dict[str, list[float]], intervals: dict[tuple[str, int], int], which: set[int]) -> DataFrame:
    """(slot, value) of the rows inside the open intervals numbered in ``which``."""
    hits = []
    for c in dict.fromkeys(c for (c, _), i in intervals.items() if i in which):

        def leaf(at: int, c: str = c) -> Column:
            i = intervals.get((c, at))
            return F.lit(i if i in which else None).cast("int")

        hits.append((_locate(F.col(c), bounds[c], leaf), F.col(c)))
    return (
        df.filter(F.coalesce(*[where for where, _ in hits]).isNotNull())
        .select(F.inline(F.array(*[F.struct(w.alias("slot"), v.alias("value")) for w, v in hits])))
        .filter(F.col("slot").isNotNull())
    )


def _pick(
    df: DataFrame, bounds: dict[str, list[float]], intervals: dict[tuple[str, int], int], wanted: list[tuple], which: set[int]
) -> DataFrame:
    """Values at given ranks inside given open intervals."""
    counts = _inside(df, bounds, intervals, which).groupBy(F.col("slot").alias("interval"), "value").count()
    upto = Window.partitionBy("interval").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("count").over(upto))
    # One row per column, probability and side: as many as the caller asked for.
    targets = df.sparkSession.createDataFrame(
        wanted,
        "`column` string, p double, is_upper boolean, weight double, interval int, rank long",
    )
    hit = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("count"))
    return (
        ranked.join(F.broadcast(targets), "interval")
        .filter(hit)
        .select("column", "p", "is_upper", "weight", "value")
    )


def quantile_map(
    df: DataFrame,
    cols: str | Sequence[str],
    ps: Sequence[float],
    accuracy: int | None = None,
    interpolate: bool = True,
    method: str = "sketch",
) -> dict[str, list[float | None]]:
    """The same as plain numbers: one list per column in the order of ``ps``."""
    cols = as_list(cols)
    got = {(r["column"], r["p"]): r["quantile"] for r in quantiles(df, cols, ps, accuracy, interpolate, method).collect()}
    return {c: [got[(c, float(p))] for p in ps] for c in cols}
