"""File sinks and the report on what they wrote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_KEYS = ("event_date", "region")

# Rows per file; with it a task that gets a large partition writes several files.
MAX_ROWS_PER_FILE = 5_000_000


def write_partitioned(
    rows: DataFrame,
    path: str,
    keys: Sequence[str] = PARTITION_KEYS,
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
) -> str:
    """Replace the partitions that the rows fall in and leave the others alone.

    The rebalance hint gathers a partition's rows to keep files few. Adaptive
    execution splits a partition that is too large for one task, so a hot day or
    region is written by many.
    """
    (
        rows.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(*keys)
        .parquet(path)
    )
    return path


def write_dead_letter(
    rejected: DataFrame, path: str, keys: Sequence[str] = ("ingest_date",)
) -> str:
    """Keep rejected rows with their reason, replaced per arrival date on reruns."""
    return write_partitioned(rejected, path, keys)


def write_csv_baseline(rows: DataFrame, path: str) -> str:
    """Unpartitioned CSV, the slow form to compare against.

    As many files as there are tasks: a single file would send all rows through
    one of them.
    """
    rows.write.mode("overwrite").options(header=True, escape='"').csv(path)
    return path


def write_parquet_baseline(rows: DataFrame, path: str) -> str:
    rows.write.mode("overwrite").parquet(path)
    return path


def partition_report(
    spark: SparkSession, path: str, keys: Sequence[str] = PARTITION_KEYS
) -> DataFrame:
    """Rows, files and bytes of each partition, to spot small files.

    Reads file metadata and partition values only. Rows are counted per file
    first, so each file's size enters once.
    """
    files = (
        spark.read.parquet(path)
        .groupBy(*keys, F.col("_metadata.file_path").alias("_file"))
        .agg(
            F.count("*").alias("_rows"),
            F.max("_metadata.file_size").alias("_bytes"),
        )
    )
    return files.groupBy(*keys).agg(
        F.sum("_rows").alias("rows"),
        F.count("*").alias("files"),
        F.sum("_bytes").alias("bytes"),
    )
