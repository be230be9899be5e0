"""Sharding by fixed virtual slots.

A record's slot is a hash of its id and text, one of ``N_SLOTS``, for ever.  Which shard
holds a slot is a small table with a version; rebalancing edits that table (it moves whole
slots) and never rehashes a record.  Bytes are aggregated per slot in one map-side combined
pass; the map and its edits work on ``N_SLOTS`` numbers, a fixed size.

Defined cases: a NULL text has no bytes (size 16) and checksum 0; a NULL id is hashed as
NULL and takes part; repeated rows share a slot and get places of their own; an empty table
gives an empty result and an untouched map; a very long text is one record of its size, so its
shard may exceed the others by it; columns besides id and text are not looked at.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.runtime import scratch_path

#: Virtual slots: thousands, fixed for the life of a data set.
N_SLOTS = 16384
#: Bytes that each record takes besides its text.
RECORD_OVERHEAD = 16


def _measures(key: str, text: str) -> tuple[Column, Column, Column]:
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    size = (F.octet_length(body) + F.lit(RECORD_OVERHEAD)).cast("long")
    crc = F.crc32(body)
    return size, crc, F.pmod(F.xxhash64(F.col(key), crc, size), F.lit(N_SLOTS)).cast("int")


def slotted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, vslot) per record; the text itself goes no further."""
    size, crc, vslot = _measures(key, text)
    return docs.select(F.col(key), size.alias("size"), crc.alias("text_crc32"), vslot.alias("vslot"))


def slot_loads(rows: DataFrame) -> list[int]:
    """Bytes per slot: at most ``N_SLOTS`` numbers reach the driver."""
    loads = [0] * N_SLOTS
    for slot, size in rows.groupBy("vslot").agg(F.sum("size")).collect():
        loads[slot] = size
    return loads


def first_map(n_shards: int) -> list[int]:
    """Version 0: slots dealt round."""
    return [slot % n_shards for slot in range(N_SLOTS)]


def rebalanced(shard_of: list[int], loads: list[int], n_shards: int, tolerance: float = 0.0) -> list[int]:
    """The next version: move single slots from the fullest to the emptiest shard while that narrows the gap.

    Of the fullest shard's slots the one nearest to half the gap goes; the loop ends when no
    move helps or the gap is within ``tolerance`` of the mean.  Shards from ``max(shard_of)+1``
    on start empty, so growing is the same edit.  Each step lowers the sum of squares, so it ends.
    """
    new = list(shard_of)
    totals = [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(new):
        totals[shard] += loads[slot]
        if loads[slot]:
            held[shard].append((loads[slot], slot))
    mean = sum(totals) / n_shards
    full = [(-t, s) for s, t in enumerate(totals)]
    bare = [(t, s) for s, t in enumerate(totals)]
    heapq.heapify(full)
    heapq.heapify(bare)
    stuck: set[int] = set()
    while full:
        t, top = heapq.heappop(full)
        if -t != totals[top] or top in stuck:
            continue
        while bare and bare[0][0] != totals[bare[0][1]]:
            heapq.heappop(bare)
        low = bare[0][1]
        gap = totals[top] - totals[low]
        if gap <= tolerance * mean:
            break
        fitting = [x for x in held[top] if x[0] < gap]
        if not fitting:
            stuck.add(top)  # its smallest slot is as large as the gap: nothing can leave it
            continue
        size, slot = min(fitting, key=lambda x: (abs(2 * x[0] - gap), x[1]))
        held[top].remove((size, slot))
        held[low].append((size, slot))
        new[slot] = low
        for shard, change in ((top, -size), (low, size)):
            totals[shard] += change
            heapq.heappush(full, (-totals[shard], shard))
            heapq.heappush(bare, (totals[shard], shard))
    return new


def append_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """Add a version to the table (version, vslot, shard); earlier ones stay as they are."""
    rows = [(version, slot, shard) for slot, shard in enumerate(shard_of)]
    spark.createDataFrame(rows, "version int, vslot int, shard int").coalesce(1).write.mode("append").parquet(path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions stored at ``path``, oldest first; none if nothing is there."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(r[0] for r in stored.select("version").distinct().collect())


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("version") == version).select("vslot", "shard")


def edit_map(spark: SparkSession, path: str, loads: list[int], n_shards: int) -> int:
    """Load the newest map at ``path``, rebalance it for ``loads`` and append the result; the version now in force.

    A map that needs no move is not stored again.  A path without a map starts with the slots
    dealt round, as version 0.
    """
    known = versions(spark, path)
    if known:
        shard_of = [r["shard"] for r in load_map(spark, path, known[-1]).orderBy("vslot").collect()]
        if max(shard_of) >= n_shards:
            raise ValueError(f"the map at {path} has {max(shard_of) + 1} shards, more than {n_shards}")
    else:
        shard_of = first_map(n_shards)
        append_map(spark, path, 0, shard_of)
        known = [0]
    new = rebalanced(shard_of, loads, n_shards)
    if new == shard_of:
        return known[-1]
    append_map(spark, path, known[-1] + 1, new)
    return known[-1] + 1


def assign(docs: DataFrame, n_shards: int = 40, key: str = "doc_id", text: str = "text", map_path: str | None = None) -> DataFrame:
    """Shard of every record under law ``bytes``: (key, size, text_crc32, law, shard, slot, grown_shard, vslot, version).

    The newest map at ``map_path`` is edited for the bytes that are there now; without a path
    the map is a new one.  ``slot`` is the record's place in its shard, 0 upwards without a gap.
    Places are counted inside a virtual slot and shifted by the counts of the shard's slots
    before it, so no task sees more than one virtual slot.
    """
    spark = docs.sparkSession
    rows = slotted(docs, key, text)
    path = map_path or scratch_path(spark, "slot-map")
    version = edit_map(spark, path, slot_loads(rows), n_shards)
    shard_of = load_map(spark, path, version)

    counts = rows.groupBy("vslot").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(shard_of), "vslot")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("vslot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = Window.partitionBy("vslot").orderBy(F.col(key), "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(place) - 1)
        .join(F.broadcast(offsets), "vslot")  # N_SLOTS rows at most
        .select(
            F.col(key),
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "vslot",
            F.lit(version).alias("version"),
        )
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, key: str = "doc_id", text: str = "text") -> None:
    """Write every record below ``path``/shard=i by the newest version of the map kept beside it."""
    spark, map_path = docs.sparkSession, f"{path}-slots"
    shard_of = load_map(spark, map_path, edit_map(spark, map_path, slot_loads(slotted(docs, key, text)), n_shards))
    vslot = _measures(key, text)[2]
    named = docs.withColumn("__vslot", vslot).join(F.broadcast(shard_of.withColumnRenamed("vslot", "__vslot")), "__vslot").drop("__vslot")
    named.write.partitionBy("shard").parquet(path)
