"""Shared plumbing: the reliable scratch folder, and lookups whose size is checked.

Two rules are kept in one place here:

* lineage is cut only through the reliable checkpoint folder the session names
  (``spark.checkpoint.dir``), so a lost executor costs a recompute, not the job;
* a side of a join is broadcast only after its rows and bytes have been measured;
  past the bound the join goes through a shuffle with the heavy keys taken out.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType

BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# A key counts as heavy above 1/HEAVY_SHARE of all rows, so there are fewer than
# HEAVY_SHARE heavy keys whatever the data looks like.
HEAVY_SHARE = 1000
# A fit is hundreds of short jobs, and each costs a task per partition: rows of one task up to
# SPREAD_TASKS tasks (more where fits run side by side), and rows of one task in larger tables.
ROWS_PER_TASK = 25_000
SHARED_TASK_ROWS = 100_000
SPREAD_TASKS = 24
LARGE_TASK_ROWS = 250_000


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for a local session without any."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            sc.setCheckpointDir(named)
        elif sc.master.startswith("local["):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table, model or stream state inside the scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, store it reliably and go on from the stored rows."""
    scratch_dir(df.sparkSession)
    return df.checkpoint()


def fit_tasks(rows: int, task_rows: int = ROWS_PER_TASK) -> int:
    """Partitions for rows that a fit goes through again and again."""
    return max(1, min(-(-rows // task_rows), SPREAD_TASKS), -(-rows // LARGE_TASK_ROWS))


def compact(df: DataFrame) -> DataFrame:
    """``df`` computed once, stored, and persisted in ``fit_tasks`` partitions; unpersist it when done."""
    kept = pin(df)
    # Dealt out evenly: a fit takes a part or some folds of the rows, and its stages wait for the longest task.
    return kept.repartition(fit_tasks(kept.count())).persist(StorageLevel.MEMORY_AND_DISK)


def side_by_side(job: Callable, items: Sequence, parallelism: int = 4) -> list:
    """``job`` of every item, in order; up to ``parallelism`` run at a time."""
    pool = ThreadPool(max(1, min(parallelism, len(items))))
    try:
        return pool.map(inheritable_thread_target(job), items, chunksize=1)
    finally:
        pool.close()


def _row_bytes(schema: StructType) -> F.Column:
    def width(f: StructField) -> F.Column:
        if isinstance(f.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(f.name), F.lit(0))
        if isinstance(f.dataType, (StructType, ArrayType, MapType)):
            return 2 * F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        return F.lit(16)

    parts = [width(f) for f in schema.fields]
    return sum(parts, F.lit(16)).cast("long")


def fits_broadcast(
    lookup: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """Measure ``lookup`` (normally a pinned aggregate) against the broadcast bound."""
    n, size = lookup.agg(F.count(F.lit(1)), F.sum(_row_bytes(lookup.schema))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    size_col: str,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Left join ``df`` to a pinned per-key ``lookup``; NULL keys find nothing.

    ``lookup`` is unique on ``on`` and carries in ``size_col`` how many rows of ``df``
    have that key.  A measured-small lookup is broadcast.  A larger one is joined by
    shuffle after the heavy keys (fewer than ``HEAVY_SHARE`` by arithmetic) went through
    a broadcast of their own, so no reducer gets a key that dominates the table.
    """
    if fits_broadcast(lookup, max_rows, max_bytes):
        return df.join(F.broadcast(lookup), on, "left")
    total = lookup.agg(F.sum(size_col)).first()[0] or 0
    heavy = lookup.filter(F.col(size_col) > total / HEAVY_SHARE)
    keyed = df.filter(F.col(on).isNotNull())
    hot = keyed.join(F.broadcast(heavy), on, "inner")
    cold = keyed.join(F.broadcast(heavy.select(on)), on, "left_anti").join(lookup, on, "left")
    unkeyed = df.filter(F.col(on).isNull())
    return hot.unionByName(cold).unionByName(unkeyed, allowMissingColumns=True)


def as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)
