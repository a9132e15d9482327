"""Lake and dashboard questions, on enriched events or on the daily aggregate.

The daily aggregate holds exact sums, so a question whose columns it has is answered from
it with the same figures and a fraction of the rows; ``coarsest`` chooses.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlake.functions import (
    completed_views,
    exact_avg,
    exact_sum,
    from_units,
    percent,
    round_half_up,
    watch_hours,
)

from viewlake.operators.rollup import PARTIALS

# Fixed value: days shown when no full date range is given.
DEFAULT_DAYS = 14


def resolve_range(
    start: date | None, end: date | None, today: date
) -> tuple[date, date]:
    """The given range, or the default days up to today if either end is open."""
    if start is None or end is None:
        return today - timedelta(days=DEFAULT_DAYS), today
    return start, end


def filter_window(
    events: DataFrame,
    regions: Sequence[str] | None,
    start: date,
    end: date,
) -> DataFrame:
    """Rows of the regions and of the days from start to end, both included.

    ``None`` means every region; an empty list selects no rows. The columns
    stay bare, so both filters prune partitions.
    """
    rows = events.where(F.col("event_date").between(F.lit(start), F.lit(end)))
    if regions is None:
        return rows
    return rows.where(F.col("region").isin(list(regions)))


def coarsest(needed: Sequence[str], *sources: DataFrame) -> DataFrame:
    """The first of the sources, coarsest first, that has the columns a question needs."""
    for rows in sources:
        if set(needed) <= set(rows.columns):
            return rows
    raise ValueError(f"no source has all of {sorted(needed)}")


def is_daily(rows: DataFrame) -> bool:
    return set(PARTIALS) <= set(rows.columns)


def _views(rows: DataFrame) -> Column:
    if is_daily(rows):
        return F.coalesce(F.sum("views"), F.lit(0).cast("long"))
    return F.count("*")


def _hours(rows: DataFrame, places: int) -> Column:
    if is_daily(rows):
        return watch_hours(from_units(F.sum("minutes_units")), places)
    return watch_hours(exact_sum(F.col("watch_minutes")), places)


def _completion(rows: DataFrame, places: int) -> Column:
    if is_daily(rows):
        rated = F.nullif(F.sum("rated_views"), F.lit(0))
        return round_half_up(from_units(F.sum("rate_units")) / rated, places)
    return round_half_up(exact_avg(F.col("completion_rate")), places)


def _completed(rows: DataFrame) -> Column:
    if is_daily(rows):
        return F.sum("completed_views")
    return completed_views()


def top_content(events: DataFrame, k: int = 20) -> DataFrame:
    """The k contents with the most watch hours."""
    return (
        events.groupBy("content_id", "title")
        .agg(
            _hours(events, 2).alias("watch_hours"),
            _views(events).alias("view_count"),
            _completion(events, 2).alias("avg_completion"),
        )
        .orderBy(F.desc("watch_hours"), "content_id")
        .limit(k)
    )


def watch_hours_by_content(events: DataFrame, k: int = 20) -> DataFrame:
    """The k region and content pairs with the most watch hours."""
    return (
        events.groupBy("region", "content_id")
        .agg(_hours(events, 2).alias("watch_hours"))
        .orderBy(F.desc("watch_hours"), "region", "content_id")
        .limit(k)
    )


def daily_trend(events: DataFrame) -> DataFrame:
    """Views and hours per day and region."""
    return (
        events.groupBy("event_date", "region")
        .agg(_views(events).alias("daily_views"), _hours(events, 1).alias("watch_hours"))
        .orderBy("event_date", "region")
    )


def completion_by_device(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("device_type")
        .agg(
            _views(events).alias("total_events"),
            _completion(events, 2).alias("avg_completion_rate"),
            _completed(events).alias("completed_views"),
        )
        .orderBy(F.desc("total_events"), "device_type")
    )


def region_breakdown(events: DataFrame) -> DataFrame:
    """Events, hours and distinct contents per region."""
    distinct = F.count_distinct("content_id").alias("unique_content")
    return _by_region(events, distinct).orderBy(F.desc("total_watch_hours"), "region")


def region_totals(events: DataFrame) -> DataFrame:
    """Events and hours per region."""
    return _by_region(events)


def _by_region(events: DataFrame, *others: Column) -> DataFrame:
    return events.groupBy("region").agg(
        *others,
        _views(events).alias("total_events"),
        _hours(events, 1).alias("total_watch_hours"),
    )


def kpis(events: DataFrame) -> DataFrame:
    """One row of key figures; on no events the sums are NULL and counts 0."""
    return events.agg(
        _views(events).alias("total_views"),
        _hours(events, 0).alias("total_watch_hours"),
        _completion(events, 2).alias("avg_completion"),
        F.count_distinct("content_id").alias("unique_content"),
    )


def trend_by_date(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_date")
        .agg(_views(events).alias("views"), _hours(events, 1).alias("watch_hours"))
        .orderBy("event_date")
    )


def weekly_trend(events: DataFrame) -> DataFrame:
    """Views and hours per week; weeks begin on Monday."""
    return (
        events.groupBy(F.to_date(F.date_trunc("week", "event_date")).alias("week_start"))
        .agg(_views(events).alias("views"), _hours(events, 1).alias("watch_hours"))
        .orderBy("week_start")
    )


def device_completion_chart(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("device_type")
        .agg(_completion(events, 2).alias("avg_completion"), _views(events).alias("events"))
        .orderBy(F.desc("events"), "device_type")
    )


def top_titles(events: DataFrame, k: int = 10) -> DataFrame:
    """The k titles with the most hours; contents that share a title stay apart,
    and a content without a title shows its id."""
    return (
        events.groupBy("title", "content_id")
        .agg(_hours(events, 1).alias("watch_hours"), _views(events).alias("views"))
        .orderBy(F.desc("watch_hours"), "content_id")
        .limit(k)
        .select(F.coalesce("title", "content_id").alias("title"), "watch_hours", "views")
    )


def launch_success(
    launches: DataFrame, regions: Sequence[str] | None = None
) -> DataFrame:
    """Launch outcomes per region and the share on time in percent."""
    if regions is not None:
        launches = launches.where(F.col("region").isin(list(regions)))
    status = F.col("launch_status")
    on_time = F.count_if(status == "on_time")
    return (
        launches.groupBy("region")
        .agg(
            F.count("*").alias("total_launches"),
            on_time.alias("on_time"),
            F.count_if(status == "delayed").alias("delayed"),
            F.count_if(status == "cancelled").alias("cancelled"),
            percent(on_time, F.count("*")).alias("success_rate"),
        )
        .orderBy("region")
    )
