"""Reproducible sampling, splitting and folds.

Every choice depends on a hash of the row key and a seed, so results do not change with
the partitioning of the input and survive task retries.  ``key`` must identify a row;
copies of one key always land on the same side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.keys import check_key, row_hash, stratum_id, uniform
from strata.operators.prefix import row_numbers
from strata.runtime import as_list, attach, fits_broadcast, pin

# Hex digits of the hash that form a bucket at first: 3 digits are 4096 buckets per stratum.
BUCKET_DIGITS = 3
# Rows of a bucket that one task may rank; larger buckets are cut by more digits.
BUCKET_ROWS = 1_000_000
HASH_DIGITS = 32
# Rows at the cut of an exact budget that are ranked as they are; more are cut by finer ranges.
DIRECT_ROWS = 100_000


def with_uniform(df: DataFrame, key: str | Sequence[str], seed: int, out: str = "u") -> DataFrame:
    """A uniform number in [0, 1) that belongs to the row key."""
    key = as_list(key)
    check_key(df, key)
    return df.withColumn(out, uniform(row_hash(key, seed)))


def sample_fraction(
    df: DataFrame, fraction: float, seed: int = 42, key: str | Sequence[str] | None = None
) -> DataFrame:
    """Bernoulli sample; without a key Spark's own seeded sample."""
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    return with_uniform(df, key, seed, "__u").filter(F.col("__u") < fraction).drop("__u")


def sample_by(
    df: DataFrame,
    cols: str | Sequence[str],
    fractions: float | Mapping[object, float],
    seed: int = 42,
    key: str | Sequence[str] | None = None,
) -> DataFrame:
    """Stratified Bernoulli sample.

    One number samples every stratum alike, which needs no look at the strata at all.  A
    mapping gives each value of the (single) stratum column its own fraction; values not
    named get none, NULL may be named.
    """
    cols = as_list(cols)
    if not isinstance(fractions, Mapping):
        return sample_fraction(df, fractions, seed, key)
    (col,) = cols
    if key is None:
        return df.sampleBy(col, dict(fractions), seed)
    dtype = df.schema[col].dataType.simpleString()
    table = df.sparkSession.createDataFrame(
        [(k, float(v)) for k, v in fractions.items()], f"__stratum {dtype}, __fraction double"
    )
    if fits_broadcast(table):
        table = F.broadcast(table)
    return (
        with_uniform(df, key, seed, "__u")
        .join(table, F.col(col).eqNullSafe(F.col("__stratum")))
        .filter(F.col("__u") < F.col("__fraction"))
        .select(*df.columns)
    )


def random_split(
    df: DataFrame, weights: Sequence[float], seed: int, key: str | Sequence[str], out: str = "part"
) -> DataFrame:
    """Add the 0-based part a row falls in; part sizes are proportional to ``weights``."""
    total = float(sum(weights))
    edges, acc = [], 0.0
    for w in list(weights)[:-1]:
        acc += w
        edges.append(acc / total)
    split = with_uniform(df, key, seed, "__u")
    part = sum((F.when(F.col("__u") >= e, 1).otherwise(0) for e in edges), F.lit(0))
    return split.withColumn(out, part).drop("__u")


def split_by_sample(
    df: DataFrame, test_fraction: float, seed: int, key: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(train, test): a Bernoulli test sample and its exact complement, without an anti-join."""
    marked = with_uniform(df, key, seed, "__u")
    test = marked.filter(F.col("__u") < test_fraction).drop("__u")
    train = marked.filter(F.col("__u") >= test_fraction).drop("__u")
    return train, test


def limit_rows(df: DataFrame, max_rows: int, seed: int, key: str | Sequence[str]) -> DataFrame:
    """Downsample to about ``max_rows`` rows in one pass; a table within the budget passes whole.

    ``exact_rows`` meets the budget to the row.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    keep = F.col("__u") * total < F.lit(float(max_rows))
    return with_uniform(df, key, seed, "__u").filter(keep).drop("__u")


def exact_rows(df: DataFrame, max_rows: int, seed: int, key: str | Sequence[str]) -> DataFrame:
    """Exactly ``max_rows`` rows, or all of a smaller table: those with the smallest keyed numbers.

    Rows are counted in 65,536 ranges of the number; the range that holds the cut is counted in
    65,536 finer ones, until one task may rank what is left.  Larger budgets hold the rows of
    smaller ones.  Copies of a key at the cut are told apart by all their columns, so that the
    rows do not depend on the partitioning.
    """
    marked = with_uniform(df, key, seed, "__u")
    low, width, wanted, digits = 0.0, 1.0, max_rows, 1 << 16
    for _ in range(3):  # the number has 52 bits
        inside = marked.filter((F.col("__u") >= low) & (F.col("__u") < low + width))
        digit = F.floor((F.col("__u") - low) / F.lit(width) * digits)
        counts = inside.groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("digit")))  # at most 65,536 rows
        cut = upto.filter(F.col("upto") > wanted).orderBy("digit").first()
        if cut is None:
            return marked.filter(F.col("__u") < low + width).drop("__u")
        width /= digits
        low += cut["digit"] * width
        wanted -= cut["upto"] - cut["n"]
        if cut["n"] <= DIRECT_ROWS:
            break
    last = marked.filter((F.col("__u") >= low) & (F.col("__u") < low + width))
    ranked = row_numbers(last.withColumn("__tie", F.xxhash64(*df.columns)), ["__u", *as_list(key), "__tie"], "__rank")
    kept = ranked.filter(F.col("__rank") < wanted).select(*df.columns)
    return marked.filter(F.col("__u") < low).select(*df.columns).unionByName(kept)


def fraction_ladder(
    df: DataFrame, fractions: Sequence[float], seed: int, key: str | Sequence[str], out: str = "fraction"
) -> DataFrame:
    """Each row once per fraction it belongs to; smaller fractions are subsets of larger ones."""
    steps = F.array(*[F.lit(float(f)) for f in fractions])
    return (
        with_uniform(df, key, seed, "__u")
        .withColumn(out, F.explode(F.filter(steps, lambda f: F.col("__u") < f)))
        .drop("__u")
    )


def _with_position(
    df: DataFrame,
    strata: Sequence[str],
    key: Sequence[str],
    seed: int,
    cuts: Callable[[Column], Sequence[Column]],
    n_cuts: int,
) -> DataFrame:
    """Add ``__above``: how many of the stratum's cut ranks lie below the row's rank.

    Rows are ranked inside their stratum by (hash, key).  A cut is a rank computed from the
    stratum size.  Instead of ranking all rows, the row standing at each cut is found, and
    every row compares itself with those:

    1. rows are counted per (stratum, leading hash digits) - a narrow aggregate;
    2. running counts name the one bucket that holds each cut; only the rows of these
       buckets are ranked;
    3. the table itself passes once, unshuffled, next to the few cut rows.

    Buckets are cut finer until the largest has at most ``BUCKET_ROWS`` rows, so a stratum
    that holds most of the table is spread in steps 1 and 2, and in step 3 it is never
    brought together.
    """
    check_key(df, key)
    narrow = df.select(
        stratum_id(strata).alias("__sid"),
        row_hash(key, seed).alias("__h"),
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(key)],
    )
    order = ["__h", *[f"__k{i}" for i in range(len(key))]]

    digits = BUCKET_DIGITS
    while True:
        cut = narrow.withColumn("__b", F.substring("__h", 1, digits))
        counts = pin(cut.groupBy("__sid", "__b").agg(F.count(F.lit(1)).alias("n")))
        largest = counts.agg(F.max("n")).first()[0] or 0
        if largest <= BUCKET_ROWS or digits >= HASH_DIGITS:
            break
        digits = min(HASH_DIGITS, digits + max(1, math.ceil(math.log(largest / BUCKET_ROWS, 16))))

    stratum = Window.partitionBy("__sid")
    upto = stratum.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    targets = pin(
        counts.withColumn("upto", F.sum("n").over(upto))
        .withColumn("rows", F.sum("n").over(stratum))
        .select(
            "__sid",
            "__b",
            "rows",
            (F.col("upto") - F.col("n")).alias("before"),
            "upto",
            F.posexplode(F.array(*[c.cast("long") for c in cuts(F.col("rows"))])).alias("cut", "rank"),
        )
        .filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
        .select("__sid", "__b", "rows", "cut", (F.col("rank") - F.col("before")).alias("place"))
    )
    in_bucket = Window.partitionBy("__sid", "__b", "cut").orderBy(*order)
    cut_rows = pin(
        cut.join(F.broadcast(targets) if fits_broadcast(targets) else targets, ["__sid", "__b"])
        .withColumn("here", F.row_number().over(in_bucket))
        .filter(F.col("here") == F.col("place"))
        .groupBy("__sid")
        .agg(
            F.max("rows").alias("__rows"),
            *[F.max(F.when(F.col("cut") == i, F.struct(*order))).alias(f"__cut{i}") for i in range(n_cuts)],
        )
    )
    mine = F.struct(F.col("__h"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(key)])
    marked = df.withColumns({"__sid": stratum_id(strata), "__h": row_hash(key, seed)})
    joined = attach(marked, cut_rows, "__sid", "__rows")
    # No row at a cut means the cut is at rank 0: every row lies above it.
    above = sum(
        (
            F.when(F.col(f"__cut{i}").isNull() | (mine > F.col(f"__cut{i}")), 1).otherwise(0)
            for i in range(n_cuts)
        ),
        F.lit(0),
    )
    return joined.withColumn("__above", above).select(*df.columns, "__above")


def mark_stratified_test(
    df: DataFrame,
    strata: str | Sequence[str],
    test_fraction: float = 0.2,
    seed: int = 42,
    key: str | Sequence[str] = (),
    out: str = "is_test",
) -> DataFrame:
    """Add ``out``: exactly ``floor(n * test_fraction + 0.5)`` rows of each stratum are test rows."""
    key = as_list(key)
    size = lambda n: [F.floor(n * F.lit(float(test_fraction)) + F.lit(0.5))]
    marked = _with_position(df, as_list(strata), key, seed, size, 1)
    return marked.withColumn(out, F.col("__above") == 0).drop("__above")


def stratified_split(
    df: DataFrame,
    strata: str | Sequence[str],
    test_fraction: float = 0.2,
    seed: int = 42,
    key: str | Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exact shares per stratum."""
    marked = mark_stratified_test(df, strata, test_fraction, seed, key, "__is_test")
    return marked.filter(~F.col("__is_test")).drop("__is_test"), marked.filter("__is_test").drop("__is_test")


def stratified_kfolds(
    df: DataFrame,
    strata: str | Sequence[str],
    k: int,
    seed: int = 42,
    key: str | Sequence[str] = (),
    out: str = "fold",
) -> DataFrame:
    """Add a fold number 0..k-1; within a stratum fold sizes differ by at most one.

    Fold = floor((rank - 1) * k / n): fold i ends at rank ceil(i * n / k).
    """
    ends = lambda n: [F.ceil(n * F.lit(i) / F.lit(k)) for i in range(1, k)]
    if k == 1:
        return df.withColumn(out, F.lit(0))
    marked = _with_position(df, as_list(strata), as_list(key), seed, ends, k - 1)
    return marked.withColumnRenamed("__above", out)


def fold_pairs(df: DataFrame, k: int, fold: str = "fold") -> list[tuple[DataFrame, DataFrame]]:
    """k (train, validation) pairs: filters over one table with a fold column."""
    return [
        (df.filter(F.col(fold) != i).drop(fold), df.filter(F.col(fold) == i).drop(fold)) for i in range(k)
    ]


def compare_distribution(population: DataFrame, sample: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Per stratum: rows, share of the population and the share that was sampled.

    Strata without any sampled row are kept and show 0.
    """
    cols = as_list(cols)
    pop = population.groupBy(*cols).agg(F.count(F.lit(1)).alias("original"))
    smp = sample.groupBy(*[F.col(c).alias(f"__s_{c}") for c in cols]).agg(F.count(F.lit(1)).alias("sampled"))
    total = pop.agg(F.sum("original")).scalar()
    pct = lambda a, b: F.round(a.cast("double") / b * F.lit(100.0), 2)
    sampled = F.coalesce(F.col("sampled"), F.lit(0))
    return (
        pop.join(smp, [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in cols], "left")
        .select(
            *cols,
            "original",
            pct(F.col("original"), total).alias("pct_original"),
            sampled.alias("sampled"),
            pct(sampled, F.col("original")).alias("pct_sampled"),
        )
        .orderBy(*cols)
    )


def share_deviation(population: DataFrame, sample: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """One row: the largest absolute difference between a stratum's share in sample and population."""
    cols = as_list(cols)
    both = compare_distribution(population, sample, cols)
    whole = both.agg(F.struct(F.sum("original").alias("p"), F.sum("sampled").alias("s"))).scalar()
    diff = F.abs(
        F.try_divide(F.col("sampled").cast("double"), whole.getField("s").cast("double"))
        - F.col("original").cast("double") / whole.getField("p").cast("double")
    )
    return both.agg(F.max(diff).alias("max_abs_diff"))


def temporal_split(
    df: DataFrame,
    date_col: str,
    train: tuple[int, int],
    validation: tuple[int, int],
    test: tuple[int, int],
    out: str = "split",
    drop_outside: bool = False,
) -> DataFrame:
    """Label rows by year ranges (inclusive); a row outside all ranges or without a
    date keeps a NULL label, unless ``drop_outside`` removes it."""
    y = F.year(F.col(date_col))
    split = (
        F.when(y.between(*train), "train").when(y.between(*validation), "val").when(y.between(*test), "test")
    )
    labelled = df.withColumn(out, split)
    return labelled.filter(F.col(out).isNotNull()) if drop_outside else labelled
