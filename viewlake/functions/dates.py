"""Date and time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; empty or broken text gives NULL, also
    under ANSI rules."""
    return text.try_cast("date")


def date_key(day: Column) -> Column:
    """A date as the integer yyyyMMdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def normalize_timestamps(
    events: DataFrame,
    source_zone: str = "UTC",
    column: str = "event_timestamp",
) -> DataFrame:
    """Bring the timestamp to UTC and add event_date, year, month and day."""
    utc = F.to_utc_timestamp(F.col(column), source_zone)
    return events.withColumns(
        {
            column: utc,
            "event_date": F.to_date(utc),
            "year": F.year(utc),
            "month": F.month(utc),
            "day": F.dayofmonth(utc),
        }
    )


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of a calendar date: ISO week, and Sunday as weekday 1."""
    return {
        "date_key": date_key(day),
        "calendar_date": day,
        "day": F.day(day),
        "week": F.weekofyear(day),
        "month": F.month(day),
        "year": F.year(day),
        "day_of_week": F.dayofweek(day),
    }


def lateness_days(arrived: str = "ingest_date", happened: str = "event_date") -> Column:
    return F.datediff(F.col(arrived), F.col(happened))
