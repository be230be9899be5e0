"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructType

from strata.runtime import as_list


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    format: str = "parquet",
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Read one table from one or many paths.

    CSV takes a header row and any codec Spark knows.  With no ``schema`` every CSV column
    is read as text (typed later by ``to_double`` and friends), which spares the extra pass
    of schema inference.  A gzip archive cannot be split: ``partitions`` spreads its rows
    before any further work.
    """
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        reader = reader.option("header", "true")
    df = reader.options(**options).load(as_list(paths))
    return df.repartition(partitions) if partitions else df


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.globStatus(path) or [])


def resolve_source(
    spark: SparkSession,
    parts_glob: str,
    archives: Iterable[str],
    min_parts: int = 3,
) -> list[str]:
    """Part files when at least ``min_parts`` are there, else every file of the first archive pattern that matches any.

    Looks through the Hadoop file system layer, so any storage Spark can read will do.
    """
    parts = _glob(spark, parts_glob)
    if len(parts) >= min_parts:
        return parts
    for archive in archives:
        found = _glob(spark, archive)
        if found:
            return found
    raise FileNotFoundError(f"fewer than {min_parts} files match {parts_glob} and no archive exists")


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns (an unnamed CSV index, say) where the table has them."""
    return df.drop(*cols)


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    files: int | None = None,
    max_records: int | None = None,
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Write a table, optionally into about ``files`` files of at most ``max_records`` rows.

    The file count comes from a rebalance in front of the writer.  ``coalesce`` would pull
    the whole upstream stage down to that many tasks; a rebalance keeps it wide, and adaptive
    execution splits oversized outputs.
    """
    if files:
        df = df.hint("rebalance", files)
    writer = df.write.format(format).mode(mode).options(**options)
    if format == "csv":
        writer = writer.option("header", "true")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def column_kind(data_type) -> str:
    if isinstance(data_type, NumericType):
        return "numeric"
    return "categorical" if isinstance(data_type, StringType) else "other"


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and kind (numeric, categorical, other)."""
    fields = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(column_kind(f.dataType)).alias("kind"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*fields)))
