"""Incremental scoring: new files in, scored rows out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.operators.models import score


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    format: str = "parquet",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Files arriving under ``path``; ``max_files`` bounds what one trigger takes."""
    reader = spark.readStream.schema(schema).format(format).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def score_stream(
    rows: DataFrame,
    model: Model,
    keep: Sequence[str],
    out: str,
    checkpoint: str,
    continuous: str | None = None,
) -> StreamingQuery:
    """Score a stream with a stored model into a parquet table.

    Scoring is stateless, so there is nothing to watermark; the file sink and its
    checkpoint make every input row appear once.  By default all files present are scored
    and the query ends; ``continuous`` ("1 minute") keeps it going.
    """
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        score(model, rows, keep)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(out)
    )
