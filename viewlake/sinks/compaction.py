"""Merge the small files of partitions."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.sinks.files import MAX_ROWS_PER_FILE, PARTITION_KEYS, partition_report

#: A partition is worth merging if its files are smaller than this on average.
SMALL_FILE = 64_000_000


def small_partitions(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = PARTITION_KEYS,
    small_file: int = SMALL_FILE,
) -> DataFrame:
    """Partitions that have several files, and small ones: rows, files and bytes."""
    report = partition_report(spark, path, keys)
    return report.where((F.col("files") > 1) & (F.col("bytes") < small_file * F.col("files")))


def compact(
    spark: SparkSession,
    path: str,
    sort_by: Sequence[str],
    keys: Sequence[str] = PARTITION_KEYS,
    busy: Collection[object] = (),
    small_file: int = SMALL_FILE,
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
) -> list[tuple]:
    """Rewrite partitions of many small files and return their keys.

    Rows keep their partition and are sorted within it, so that row groups can be skipped
    by the least and greatest value of ``sort_by``. Partitions whose first key is in
    ``busy``, as a run is writing them, are left alone. A partition is replaced as the
    write is committed; a reader sees it before or after.
    """
    found = small_partitions(spark, path, keys, small_file)
    if busy:
        found = found.where(~F.col(keys[0]).isin(list(busy)))
    chosen = [tuple(row) for row in found.select(*keys).collect()]  # as many as partitions
    if not chosen:
        return []
    rows = spark.read.parquet(path)
    wanted = F.lit(False)
    for values in chosen:
        wanted = wanted | _all_equal(keys, values)
    (
        rows.where(wanted)
        .hint("rebalance", *keys)
        .sortWithinPartitions(*keys, *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(*keys)
        .parquet(path)
    )
    return chosen


def _all_equal(keys: Sequence[str], values: tuple):
    same = F.lit(True)
    for key, value in zip(keys, values):
        same = same & F.col(key).eqNullSafe(F.lit(value))
    return same
