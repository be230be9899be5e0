"""Training sequences by power-of-two decomposition.

A document's ids, closed by an end id, are cut along the binary digits of their number: as
many pieces of ``longest`` ids as fit, then one piece for each digit of the rest, longest
first.  Every piece is a sequence of its own, so no sequence crosses documents; sequences of
equal length form a bucket, so none is padded.  The buckets are the partitions of a table:

    length=4096/  doc_id | start | doc_tokens | ids (unsigned 32-bit, little-endian)
    length=2048/  ...

Sequences are numbered without gaps: bucket by bucket, longest first, then by document.

Defined cases: NULL and empty texts are one sequence of the end id; a NULL id is kept and
numbered last in its bucket; repeated rows are packed once each (rows of one id are ordered by
their ids' checksums, so equal rows give equal numbers in any order); very long texts are
encoded whole and give as many pieces as they need; an empty table gives an empty result;
other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import in_batches, numbered
from strata.llm.token_files import encoder, memory_of
from strata.runtime import scratch_path

LONGEST = 4096
END_ID = 2
PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary"


def pieces(counts: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of every piece of documents with ``counts`` ids, in order."""
    digits = longest.bit_length() - 1
    lengths = 1 << np.arange(digits, -1, -1)
    times = np.empty((len(counts), digits + 1), np.int64)
    times[:, 0] = counts >> digits
    times[:, 1:] = (counts[:, None] >> np.arange(digits - 1, -1, -1)) & 1
    of = np.repeat(np.arange(len(counts)), times.sum(axis=1))
    length = np.repeat(np.tile(lengths, len(counts)), times.ravel())
    ends = np.cumsum(length)
    before = np.cumsum(counts) - counts
    return of, ends - length - before[of], length


def write_buckets(
    docs: DataFrame, vocabulary: str, folder: str, longest: int = LONGEST, end_id: int = END_ID, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every text and write its pieces, one folder per length; the table as it lies there."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"{longest} is no power of two")
    spark = docs.sparkSession

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, ids = encoder(vocabulary).encode(batch.column(1).to_pylist(), end_id)
        of, start, length = pieces(counts, longest)
        edges = np.append(0, np.cumsum(length)) * 4
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(of)),
                pa.array(start),
                pa.array(length, pa.int32()),
                pa.array(counts[of]),
                pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(edges.astype("<i4").tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())]),
            ],
            names=["doc_id", "start", "length", "doc_tokens", "ids"],
        )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    cuts = rows.mapInArrow(lambda batches: in_batches(batches, cut, 2 << 20, memory_of(vocabulary)), PIECES)
    cuts.write.partitionBy("length").option("compression", "zstd").parquet(folder)
    return buckets(spark, folder)


def buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces in a folder of buckets."""
    return spark.read.schema(PIECES).parquet(folder)


def sequences(packed: DataFrame) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece, read from the buckets.

    The numbering moves a few numbers per piece, never the ids.
    """
    rows = packed.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    rows = rows.withColumn("shorter", -F.col("length"))
    order = ["shorter", "doc_id", "doc_tokens", "start", "ids_crc32"]
    return numbered(rows, order, rank="sequence_id").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset")
    )


def pack(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write the buckets into the scratch folder and return what they hold."""
    folder = scratch_path(docs.sparkSession, "sequences")
    return sequences(write_buckets(docs, vocabulary, folder, **options))
