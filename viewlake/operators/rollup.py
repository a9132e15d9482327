"""Aggregation to the daily grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlake.functions import (
    exact_avg,
    exact_sum,
    exact_units,
    from_units,
    round_half_up,
    watch_hours,
)

DAILY_GRAIN = ("content_id", "region", "device_type", "event_date")


# Sums that can be summed again, next to the rounded measures.
PARTIALS = ("minutes_units", "rate_units", "rated_views")


def aggregate_daily(
    derived: DataFrame, grain: Sequence[str] = DAILY_GRAIN, partials: bool = False
) -> DataFrame:
    """One row per content, region, device and day.

    A missing completion rate is left out of the average; the warehouse fact
    counts it as zero instead. With ``partials`` the row also has the exact sums, from
    which the figures of any coarser grain follow; see ``operators.marts``.
    """
    minutes = exact_sum(F.col("watch_minutes"))
    rate = F.col("completion_rate")
    exact = {
        "minutes_units": exact_units(F.col("watch_minutes")),
        "rate_units": exact_units(rate),
        "rated_views": F.count(rate),
    }
    return derived.groupBy(*grain).agg(
        F.count("*").alias("views"),
        minutes.alias("total_watch_minutes"),
        watch_hours(minutes).alias("total_watch_hours"),
        F.count_if("is_completed").alias("completed_views"),
        round_half_up(exact_avg(rate), 4).alias("avg_completion_rate"),
        *(exact[name].alias(name) for name in PARTIALS if partials),
    )


def salted_sums(
    rows: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    spread_by: str,
    salts: int = 32,
) -> DataFrame:
    """Row count and exact sums per key in two steps, the first on key and salt.

    Plain aggregation already combines a hot key within each map task. The salt
    helps when there are so many map tasks that even one partial row from each
    is a hot group.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    partial = (
        rows.withColumn("_salt", salt)
        .groupBy(*keys, "_salt")
        .agg(
            F.count("*").alias("_rows"),
            *(exact_units(c).alias(name) for name, c in sums.items()),
        )
    )
    return partial.groupBy(*keys).agg(
        F.sum("_rows").alias("rows"),
        *(from_units(F.sum(name)).alias(name) for name in sums),
    )
