"""Deduplication: keep the latest row per key, hand out the others.

Rows of one key are ordered by the timestamp, then by every other column, all
descending with NULLs last. Rows that tie are equal in every column, so the
outcome does not depend on task order.

Neither side gathers a key's rows in one task. The survivors come from a
``row_number() = 1`` filter, which Spark turns into a group limit before the
shuffle: each map task sends one row per key. The superseded rows come from
counts and maxima, which also combine before their shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlake.operators.validate import REASON

DUPLICATE = "DUPLICATE_EVENT_ID"

# Exact copies are written out in portions of this size, each by its own task.
COPIES_PER_PORTION = 100_000


def _rest(rows: DataFrame, keys: Sequence[str], latest_by: str) -> list[str]:
    return [c for c in rows.columns if c not in keys and c != latest_by]


def keep_latest(
    rows: DataFrame,
    keys: Sequence[str] = ("event_id",),
    latest_by: str = "event_timestamp",
) -> DataFrame:
    """The latest row of each key; one shuffle of at most a row per key and task."""
    order = [latest_by, *_rest(rows, keys, latest_by)]
    newest_first = Window.partitionBy(*keys).orderBy(
        *(F.col(c).desc_nulls_last() for c in order)
    )
    return (
        rows.withColumn("_place", F.row_number().over(newest_first))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def superseded(
    rows: DataFrame,
    keys: Sequence[str] = ("event_id",),
    latest_by: str = "event_timestamp",
    reason: str = DUPLICATE,
) -> DataFrame:
    """Every row that ``keep_latest`` leaves out, with a rejection reason.

    Only keys that occur more than once go past the first, narrow count.
    """
    order = [latest_by, *_rest(rows, keys, latest_by)]
    members = _repeated_members(rows, keys)
    variants = members.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))
    # The count is part of the maximum only so that both uses share one shuffle.
    place = F.struct(*order, "_copies")
    newest = variants.groupBy(*keys).agg(F.max(place).alias("_newest"))
    is_newest = place.eqNullSafe(F.col("_newest"))
    losers = (
        _null_safe_join(variants, newest, keys, "inner")
        .withColumn("_copies", F.col("_copies") - F.when(is_newest, 1).otherwise(0))
        .where(F.col("_copies") > 0)
        .select(*rows.columns, "_copies")
    )
    return _write_out(losers).withColumn(REASON, F.lit(reason))


def deduplicate(
    rows: DataFrame,
    keys: Sequence[str] = ("event_id",),
    latest_by: str = "event_timestamp",
) -> tuple[DataFrame, DataFrame]:
    """(unique, duplicates); together they hold every input row once."""
    return keep_latest(rows, keys, latest_by), superseded(rows, keys, latest_by)


def _repeated_members(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    repeated = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > 1)
        .select(*keys)
    )
    return _null_safe_join(rows, repeated, keys, "left_semi")


def _null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    """Equi-join in which NULL keys match; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    matches: list[Column] = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = left.join(renamed, matches, how)
    return joined.drop(*(f"_{k}" for k in keys))


def _write_out(counted: DataFrame) -> DataFrame:
    """Repeat each row ``_copies`` times, spreading rows and copies over tasks.

    Rows are spread by all their columns, so neither many copies of a row nor
    many rows of a key meet in one task. The partition count is given, since
    adaptive execution would merge the portions, which are small until they are
    written out.
    """
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [c for c in counted.columns if c != "_copies"]
    size = F.lit(COPIES_PER_PORTION)
    last = ((F.col("_copies") - 1) / size).cast("long")
    portions = counted.withColumn(
        "_portion", F.explode(F.sequence(F.lit(0).cast("long"), last))
    ).withColumn("_copies", F.least(size, F.col("_copies") - F.col("_portion") * size))
    return (
        portions.repartition(tasks, *columns, "_portion")
        .withColumn(
            "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
        )
        .drop("_portion", "_copies", "_copy")
    )
