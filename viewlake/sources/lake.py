"""Parquet reads: whole datasets, one partition, and SQL over views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lake(spark: SparkSession, base: str, merge_schema: bool = False) -> DataFrame:
    """Read a partitioned dataset from its base path.

    ``merge_schema`` reads files written before a column was added as NULL in
    that column.
    """
    return spark.read.option("mergeSchema", merge_schema).parquet(base)


def read_partition(spark: SparkSession, base: str, **values: object) -> DataFrame:
    """Read the partitions with the given values.

    A missing dataset is an error; it is never replaced by another zone.
    """
    rows = read_lake(spark, base)
    for column, value in values.items():
        rows = rows.where(F.col(column) == F.lit(value))
    return rows


def open_view(spark: SparkSession, name: str, base: str) -> None:
    """Name a dataset so that SQL can query it."""
    read_lake(spark, base).createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL in which ``{name}`` stands for a DataFrame given by keyword."""
    return spark.sql(sql, **frames)
