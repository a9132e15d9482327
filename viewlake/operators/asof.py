"""Point-in-time join: each event with the version that was valid when it happened.

There is no join by a range of times. Versions and events of a key are put in one order
of time, and each event takes the last version before it. So that a key with very many
events is no single task's work, that order is cut into periods: a period begins with the
version in force at its start, which is found in the same way among the periods that hold
events, at most one row for each key and period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(
    events: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    time: str = "event_timestamp",
    valid_from: str = "valid_from",
    valid_to: str | None = "valid_to",
    period: str = "day",
) -> DataFrame:
    """Every event with the columns of the version of its keys that began last, at or
    before the event's time; NULLs where there is none, or where it had ended.

    Of versions that begin at one time the greatest is taken. Events without a time or a
    key keep NULLs.
    """
    names = [c for c in versions.columns if c not in keys]
    at, tag, version, of = F.col("_at"), F.col("_is_event"), F.col("_version"), F.col("_period")
    begun = versions.select(
        *keys,
        F.col(valid_from).cast("timestamp").alias("_at"),
        F.struct(*names).alias("_version"),
    ).where(at.isNotNull()).dropna(subset=list(keys))
    begun = begun.groupBy(*keys, "_at").agg(F.max("_version").alias("_version"))
    begun = begun.withColumn("_period", F.date_trunc(period, at))
    placed = events.select(
        *(F.col(k) for k in keys),
        F.struct(*events.columns).alias("_event"),
        F.col(time).cast("timestamp").alias("_at"),
    ).withColumn("_period", F.date_trunc(period, at))

    # The version in force as a period begins, for each period that holds events.
    starts = placed.select(*keys, of.alias("_at")).where(at.isNotNull()).distinct()
    starts = starts.withColumns({"_version": _nothing(versions, names), "_is_event": F.lit(True)})
    known = begun.select(*keys, "_at", "_version", F.lit(False).alias("_is_event"))
    in_order = Window.partitionBy(*keys).orderBy(at, tag)
    carried = (
        starts.unionByName(known)
        .withColumn("_version", _last(version, in_order))
        .where(tag & version.isNotNull())
        .select(*keys, "_at", at.alias("_period"), "_version")
    )

    rows = placed.withColumns({"_version": _nothing(versions, names), "_is_event": F.lit(True)})
    by_period = Window.partitionBy(*keys, "_period").orderBy(at, tag)
    nobody = F.lit(None).cast(dict(rows.dtypes)["_event"])
    begun = begun.unionByName(carried).withColumns({"_event": nobody, "_is_event": F.lit(False)})
    joined = (
        rows.unionByName(begun)
        .withColumn("_version", _last(version, by_period))
        .where(tag)
    )
    if valid_to is not None:
        ended = F.col(f"_version.{valid_to}").cast("timestamp") <= at
        joined = joined.withColumn("_version", F.when(~F.coalesce(ended, F.lit(False)), version))
    return joined.select("_event.*", *(F.col(f"_version.{n}").alias(n) for n in names))


def _nothing(versions: DataFrame, names: Sequence[str]) -> Column:
    kind = versions.select(F.struct(*names).alias("v")).dtypes[0][1]
    return F.lit(None).cast(kind)


def _last(version: Column, order) -> Column:
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(version, ignorenulls=True).over(running)
