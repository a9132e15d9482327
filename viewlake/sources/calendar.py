"""A generated series of dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_series(
    spark: SparkSession, start: date, end: date, column: str = "calendar_date"
) -> DataFrame:
    """One row per day from start to end, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(column))
