"""Which dates to process: new arrivals, late events, ranges."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.functions import lateness_days
from viewlake.sources.calendar import date_series


def new_partitions(
    raw: DataFrame, processed: DataFrame, column: str = "ingest_date"
) -> DataFrame:
    """Dates that landed and were not processed yet, given one row per date."""
    return raw.select(column).subtract(processed.select(column))


def late_window(
    processed: DataFrame, today: date, days: int = 2, column: str = "ingest_date"
) -> DataFrame:
    """Processed dates from ``days`` before today up to today."""
    start = today - timedelta(days=days)
    return processed.select(column).where(
        F.col(column).between(F.lit(start), F.lit(today))
    )


def late_events(normalized: DataFrame, at_least: int = 3) -> DataFrame:
    """Events that arrived at least that many days after they happened."""
    return normalized.withColumn("lateness_days", lateness_days()).where(
        F.col("lateness_days") >= at_least
    )


def affected_dates(normalized: DataFrame) -> DataFrame:
    """Event dates that the given arrivals touch, and how many rows each gets.

    Unlike a fixed window this finds every late event, however late it is.
    """
    return (
        normalized.where(F.col("event_date").isNotNull())
        .groupBy("event_date")
        .agg(
            F.count("*").alias("arrived_rows"),
            F.max(lateness_days()).alias("max_lateness_days"),
        )
    )


def parse_date_range(
    start: str, end: str | None = None, today: date | None = None
) -> list[date]:
    """Every date from start to end; "all" gives an empty list, which callers
    read as every raw date. An inverted range is an error."""
    if start == "all":
        return []
    first = date.fromisoformat(start)
    last = date.fromisoformat(end) if end else (today or date.today())
    if first > last:
        raise ValueError(f"start {first} is after end {last}")
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def backfill_range(
    spark: SparkSession, events: DataFrame, start: date, end: date
) -> DataFrame:
    """Rows per ingest date of a range in one job; a date without raw data has -1."""
    counts = (
        events.where(F.col("ingest_date").between(F.lit(start), F.lit(end)))
        .groupBy("ingest_date")
        .agg(F.count("*").alias("rows"))
    )
    return (
        date_series(spark, start, end, "ingest_date")
        .join(counts, "ingest_date", "left")
        .select("ingest_date", F.coalesce("rows", F.lit(-1).cast("long")).alias("rows"))
    )
