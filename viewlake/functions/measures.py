"""Derived measures of a viewing event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlake.functions.dates import parse_date
from viewlake.functions.exact import round_half_up
from viewlake.schemas import COMPLETED_AT


def launch_delay_days(
    actual: str = "actual_launch_date", planned: str = "planned_launch_date"
) -> Column:
    """Days from planned to actual launch, NULL when either date is missing."""
    return F.datediff(parse_date(F.col(actual)), parse_date(F.col(planned)))


def watch_hours(minutes: Column, places: int = 2) -> Column:
    return round_half_up(minutes / F.lit(60.0), places)


def is_completed(rate: str = "completion_rate") -> Column:
    """True from the completion threshold on; a missing rate is not completed."""
    return F.coalesce(F.col(rate) >= F.lit(COMPLETED_AT), F.lit(False))


def completed_views(rate: str = "completion_rate") -> Column:
    return F.count_if(F.col(rate) >= F.lit(COMPLETED_AT))


def derive_fields(enriched: DataFrame) -> DataFrame:
    """Add launch_delay_days, watch_hours and is_completed in one projection."""
    return enriched.withColumns(
        {
            "launch_delay_days": launch_delay_days(),
            "watch_hours": watch_hours(F.col("watch_minutes")),
            "is_completed": is_completed(),
        }
    )
