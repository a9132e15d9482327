"""Events and launches kept in the same buckets, so that joining them moves no events.

Both tables are dealt to buckets by content, region and a salt, and sorted within. A join
on these keys reads bucket against bucket: the shuffle is paid once, when events are
written, and not by every question. The salt parts a content that is hot even within its
region: events get one of ``salts`` numbers by a hash, and each launch is kept under all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.operators.enrich import is_declared_unique, one_row_per_key

KEYS = ("content_id", "region")
SALT = "bucket_salt"


@dataclass(frozen=True)
class Colocated:
    """Names of the two tables in the catalog."""

    events: str
    launches: str


def write_colocated(
    events: DataFrame,
    launches: DataFrame,
    names: Colocated,
    base: str,
    buckets: int,
    salts: int = 1,
    spread_by: str = "event_id",
) -> None:
    """Write both tables under ``base``, one sorted file for each bucket."""
    if not is_declared_unique(launches, KEYS):
        launches = one_row_per_key(launches, KEYS)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    for rows, name in (
        (events.withColumn(SALT, salt), names.events),
        (launches.withColumn(SALT, every), names.launches),
    ):
        _write_bucketed(rows, name, f"{base}/{name.rsplit('.', 1)[-1]}", (*KEYS, SALT), buckets)


def _write_bucketed(
    rows: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int
) -> None:
    (
        rows.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(name)
    )


def join_colocated(spark: SparkSession, names: Colocated) -> DataFrame:
    """The events with their launches, bucket by bucket."""
    launches = spark.table(names.launches).hint("merge")
    joined = spark.table(names.events).join(launches, [*KEYS, SALT], "left")
    return joined.drop(SALT)


def drop_colocated(spark: SparkSession, names: Colocated) -> None:
    """Forget both tables; their files stay."""
    for name in (names.events, names.launches):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
