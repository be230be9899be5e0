"""What several of the operators share: tables, words, identifiers, fixed-size count vectors."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.runtime import scratch_path

#: A word is a run of anything but ASCII white space; ``bytes.split`` cuts at the same bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Cells of a count vector: 2 M counters, 8 MB, whatever the size of the input.
CELLS = 1 << 21
SLICES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, limit_bytes: int = 4 << 20):
    """Batches between the JVM and Python of at most ``limit_bytes`` (or a row): both sides hold some at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, f"{limit_bytes}b")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


class WordHashes(dict):
    """64-bit hashes of words, remembered; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 250_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_memory: dict[str, object] = {}


def worker_memory(name: str, make: Callable[[], object]):
    """What a Python worker keeps from task to task: one thing at a time, so that stages do not pile up."""
    if name not in _memory:
        release_memory()
        _memory[name] = make()
    return _memory[name]


def release_memory(keeps: str | None = None) -> None:
    """Let go of what earlier stages keep, when a task starts that keeps nothing or another thing.

    Freed memory goes back to the system: executors count what their workers hold, not what they use.
    """
    if _memory and keeps not in _memory:
        _memory.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


#: Returns free heap pages; only some C libraries have it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that every bit depends on every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def cell_of(h: np.ndarray) -> np.ndarray:
    """The counter of a 64-bit value."""
    return (mixed(h.astype(np.uint64, copy=False)) & np.uint64(CELLS - 1)).astype(np.int64)


def vector_rows(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    """A task's count vector as compressed slices, for a sum over all tasks."""
    step = CELLS // SLICES
    parts = [counts[i * step : (i + 1) * step] for i in range(SLICES)]
    kept = [i for i, p in enumerate(parts) if p.any()]
    return kept, [zlib.compress(parts[i].astype("<i8").tobytes(), 1) for i in kept]


def summed_vector(rows: DataFrame) -> np.ndarray:
    """Sum the slices (columns ``slice int, cells binary``) of all tasks: ``CELLS`` counters, a fixed 16 MB."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        total = np.zeros(CELLS // SLICES, np.int64)
        for batch in batches:
            for blob in batch.column("cells"):
                total += np.frombuffer(zlib.decompress(blob.as_py()), "<i8")
        yield pa.RecordBatch.from_pydict({"slice": pa.array([key[0].as_py()], pa.int32()), "cells": [zlib.compress(total.tobytes(), 1)]})

    # two levels, so that no task reads the slices of every other task
    fold = rows.withColumn("part", F.abs(F.hash(F.length("cells"), F.crc32("cells"))) % 16)
    fold = fold.groupBy("slice", "part").applyInArrow(add, "slice int, cells binary")
    total = np.zeros(CELLS, np.int64)
    step = CELLS // SLICES
    for row in fold.groupBy("slice").applyInArrow(add, "slice int, cells binary").collect():
        total[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(zlib.decompress(bytes(row["cells"])), "<i8")
    return total


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """A fixed-size bitmap that holds every id of the one BIGINT column, and some others by chance."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        seen = np.zeros(CELLS, np.int64)
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            seen[cell_of(values.astype(np.int64).view(np.uint64))] = 1
        slices, cells = vector_rows(seen)
        yield pa.RecordBatch.from_pydict({"slice": pa.array(slices, pa.int32()), "cells": pa.array(cells, pa.binary())})

    return summed_vector(ids.mapInArrow(count, "slice int, cells binary")) > 0


def in_bitmap(bitmap: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Whether the bitmap may hold each BIGINT id; false for NULL."""
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return bitmap[cell_of(values.view(np.uint64))] & known


def maybe_in(bitmap, column: str) -> Column:
    """Whether the broadcast ``bitmap`` may hold the id: false is certain, NULL ids are false."""

    @F.arrow_udf("boolean")
    def test(ids: pa.Array) -> pa.Array:
        if _memory:
            release_memory()
        return pa.array(in_bitmap(bitmap.value, ids))

    return test(F.col(column).cast("long"))


def drop_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``key`` is among ``ids`` (one BIGINT column).

    A bitmap of fixed size lets most rows stay where they are; only rows that it cannot
    clear go through the exact anti join.  The result is exact at any size: a full bitmap
    only sends more rows through the join.
    """
    ids = ids.toDF("__gone").filter(F.col("__gone").isNotNull())
    bitmap = df.sparkSession.sparkContext.broadcast(id_bitmap(ids))
    marked = df.withColumn("__maybe", maybe_in(bitmap, key))
    clear = marked.filter(~F.col("__maybe")).drop("__maybe")
    rest = marked.filter(F.col("__maybe")).drop("__maybe")
    return clear.unionByName(rest.join(ids.distinct(), F.col(key) == F.col("__gone"), "left_anti"))


def numbered(df: DataFrame, order: list[str], sums: tuple[str, ...] = (), rank: str = "rank", prefix: str = "before_") -> DataFrame:
    """Global 0-based ``rank`` of each row along ``order`` and, per column of ``sums``, the total of the rows before it.

    Range partitions are stored once; their counts and totals (one row per partition) give the
    offsets, a window inside a partition gives the rest.  No task sees more than one range.
    Columns of ``order`` must tell rows apart, NULL sorts last.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(df.repartitionByRange(parts, *by).withColumn("__part", F.spark_partition_id()), "ranges")
    totals = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__t_{c}") for c in sums])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = totals.select(
        "__part",
        F.coalesce(F.sum("__n").over(earlier), zero).alias("__n0"),
        *[F.coalesce(F.sum(f"__t_{c}").over(earlier), zero).alias(f"__s_{c}") for c in sums],
    )
    inside = Window.partitionBy("__part").orderBy(*by)
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(F.broadcast(offsets), "__part")  # one row per partition of the shuffle
    return joined.select(
        *df.columns,
        (F.col("__n0") + F.row_number().over(inside) - 1).cast("long").alias(rank),
        *[(F.col(f"__s_{c}") + F.coalesce(F.sum(c).over(above), zero)).alias(f"{prefix}{c}") for c in sums],
    )


def in_batches(
    batches: Iterator[pa.RecordBatch], fn: Callable, limit_bytes: int = 4 << 20, keeps: str | None = None
) -> Iterator[pa.RecordBatch]:
    """Apply ``fn`` to each batch cut into pieces of about ``limit_bytes``, so that long texts do not pile up.

    ``keeps`` names the ``worker_memory`` that ``fn`` uses; any other is released first.
    """
    release_memory(keeps)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        pieces = max(1, min(batch.num_rows, -(-batch.nbytes // limit_bytes)))
        step = -(-batch.num_rows // pieces)
        for start in range(0, batch.num_rows, step):
            yield from fn(batch.slice(start, step))
