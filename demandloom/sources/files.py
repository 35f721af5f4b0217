"""Order files: text as a stream or batch, history as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import config

_METADATA_FIELDS = {
    "_source_file_name": "file_name",
    "_source_file_path": "file_path",
    "_source_file_modification_time": "file_modification_time",
}


def with_source_columns(df: DataFrame) -> DataFrame:
    """Name the source file of each row.

    Must run on the scan itself: the hidden column is gone inside foreachBatch.
    """
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.col(f"_metadata.{field}").alias(name) for name, field in _METADATA_FIELDS.items()],
    )


def stream_order_files(
    spark: SparkSession, folder: str, pattern: str = "*.txt", max_files_per_batch: int | None = None
) -> DataFrame:
    """A stream of text lines with their source file; files already there count as new."""
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return with_source_columns(reader.load(folder))


def read_order_files(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    return with_source_columns(spark.read.option("pathGlobFilter", pattern).text(folder))


def read_history(spark: SparkSession, folder: str) -> DataFrame:
    """Historical Parquet below ``folder``, subfolders included, with source columns."""
    scan = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    return with_source_columns(scan.drop(*config.SOURCE_COLUMNS))
