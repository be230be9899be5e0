"""Set and difference operators with NULL-safe meaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.runtime import as_list


#: Copies of a row that one task emits at a time.
CHUNK_ROWS = 100_000


def fingerprint(cols: Sequence[Column], out: str = "__fp") -> list[Column]:
    """128 bits of a row as two BIGINT columns, ``out``1 and ``out``2.

    Equal rows have equal fingerprints: NULL equals NULL, NaN equals NaN, 0.0 equals -0.0.  Which
    values are NULL is hashed first, as the hash passes over them.  Rows that differ share one
    with a chance of about n * n / 2 ** 129 in n rows.
    """
    missing = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(F.lit(seed), missing, *cols).alias(f"{out}{seed}") for seed in (1, 2)]


def _typed(df: DataFrame, other: DataFrame, cols: list[str]) -> tuple[list[Column], list[Column]]:
    """The columns of both frames in the type that a union would give them, so that equal values hash alike."""
    types = df.select(*cols).union(other.select(*cols)).schema
    return tuple([frame[c].cast(f.dataType).alias(c) for c, f in zip(cols, types)] for frame in (df, other))


def remainder(df: DataFrame, part: DataFrame, key: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key (all columns when none is given) does not occur in ``part``.

    NULL equals NULL, so a row with a missing value cannot stay on both sides of a split.
    ``part`` is reduced to the distinct fingerprints of its keys, two numbers a key however wide
    it is, before the join; copies within ``df`` are kept.
    """
    key = as_list(key) if key else df.columns
    left, right = _typed(df, part, key)
    taken = part.select(*fingerprint(right, "__taken")).distinct()
    same = (F.col("__fp1") == F.col("__taken1")) & (F.col("__fp2") == F.col("__taken2"))
    marked = df.select("*", *fingerprint(left))
    return marked.join(taken, same, "left_anti").drop("__fp1", "__fp2")


def row_difference(df: DataFrame, other: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Multiset difference: each row of ``other`` takes away one equal row (NULL equals NULL).

    Both sides are counted where they stand, so copies of a row travel as one: ``other`` as
    fingerprints and counts, ``df`` as its different rows and counts.  What is left of a row is
    emitted in chunks of ``chunk_rows``; where a row has more than one, they are dealt over all tasks.
    Columns are matched by name and come in the types that a union would give them.
    """
    cols = df.columns
    left, right = _typed(df, other, cols)
    had = df.select(*left).groupBy(*cols).agg(F.count(F.lit(1)).alias("__had"))
    had = had.select("*", *fingerprint([F.col(c) for c in cols]))
    gone = other.select(*fingerprint(right)).groupBy("__fp1", "__fp2").agg(F.count(F.lit(1)).alias("__gone"))
    surplus = F.col("__had") - F.coalesce(F.col("__gone"), F.lit(0))
    left_over = had.join(gone, ["__fp1", "__fp2"], "left").withColumn("__n", surplus).filter("__n > 0").select(*cols, "__n")

    def copies(rows: DataFrame, n: Column) -> DataFrame:
        return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), n))).select(*cols)

    chunks = left_over.filter(F.col("__n") > chunk_rows).withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / chunk_rows)))
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(parts, "__chunk", *cols)
    size = F.least(F.lit(chunk_rows).cast("long"), F.col("__n") - F.col("__chunk") * chunk_rows)
    return copies(left_over.filter(F.col("__n") <= chunk_rows), F.col("__n")).unionAll(copies(dealt, size))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; absent columns are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def distinct_rows(df: DataFrame, cols: str | Sequence[str] | None = None) -> DataFrame:
    return (df.select(*as_list(cols)) if cols else df).distinct()
