"""The batch logic on streams of files.

A stream takes in what has not been read yet and stops (``availableNow``), or
keeps running under another trigger. Its checkpoint remembers the files, so no
list of processed folders is needed. Sinks append Parquet exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from viewlake.operators.validate import is_valid
from viewlake.plans.transform import check_events
from viewlake.session import STATE_SETTINGS
from viewlake.sinks.versions import kept_pointers, newest_pointer, publish, version_path
from viewlake.sources.paths import drop_partitions, exists, partition_paths
from viewlake.sources.raw import raw_events_options, raw_events_schema

TIME = "event_timestamp"
DAY = "window_day"
DAY_FIELD = StructField(DAY, StringType())
ROW = "_row"


def open_files(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    source: str = "parquet",
    files: str = "*",
    max_files: int | None = None,
    **options: object,
) -> DataFrame:
    """A stream of the files in a folder, a bounded number per batch if wanted."""
    reader = spark.readStream.format(source).schema(schema).options(**options)
    if files != "*":
        reader = reader.option("pathGlobFilter", files)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def open_raw_events(
    spark: SparkSession, base: str, max_files: int | None = None
) -> DataFrame:
    """Landed CSV events as a stream, with the options of the batch reader."""
    return open_files(
        spark,
        base,
        raw_events_schema(),
        source="csv",
        max_files=max_files,
        **raw_events_options(),
    )


def check_arrivals(raw: DataFrame) -> DataFrame:
    """Normalized events with their rejection reason and status."""
    status = F.when(is_valid(), "valid").otherwise("rejected")
    return check_events(raw).withColumn("status", status)


def dedup_stream(
    events: DataFrame, delay: str, keys: Sequence[str] = ("event_id",)
) -> DataFrame:
    """One row per key among rows that arrive within the delay of each other.

    This keeps the first row seen, whereas the batch keeps the latest: a stream
    has already sent the first one on. Spark forgets a key once the watermark
    has passed it, which bounds the state.
    """
    return events.withWatermark(TIME, delay).dropDuplicatesWithinWatermark(list(keys))


def hourly_counts(
    events: DataFrame,
    by: Sequence[str] = ("region", "event_type"),
    delay: str | None = None,
    length: str = "1 hour",
) -> DataFrame:
    """Events per time window and group, on a batch or, given a delay, a stream.

    A stream sends a window on once the watermark has passed its end.
    """
    if delay is not None:
        events = events.withWatermark(TIME, delay)
    return (
        events.groupBy(F.window(TIME, length).alias("_window"), *by)
        .agg(F.count("*").alias("events"))
        .select(
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *by,
            "events",
        )
    )


def run_available(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Process everything that is there, append it to Parquet and return the table."""
    running = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start(path)
    )
    running.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def count_into(
    events: DataFrame,
    base: str,
    checkpoint: str,
    by: Sequence[str] = ("region", "event_type"),
    length: str = "1 hour",
) -> DataFrame:
    """Fold everything that is there into a table of counts and return the table.

    No state is kept between batches: each one is counted on its own, and the days its
    windows fall on are written again with the counts added. They become current by a
    pointer that also says which batch it includes. A batch that Spark repeats after a
    failure is either in the pointer and left out, or in no pointer and done anew.
    Windows stay open for ever, so no row comes too late.
    """
    spark = events.sparkSession
    pointer = newest_pointer(spark, base)
    if pointer is not None and not exists(spark, f"{checkpoint}/offsets"):
        # A new checkpoint counts its batches from 0, and reads all files again.
        raise ValueError(f"{base} was filled from another checkpoint")

    def fold(batch: DataFrame, number: int) -> None:
        _fold_counts(hourly_counts(batch, by, length=length), base, by, number)

    _run_batches(events, checkpoint, fold)
    return read_counts(spark, base, hourly_counts(events, by, length=length).schema)


def _fold_counts(
    counts: DataFrame, base: str, by: Sequence[str], number: int
) -> None:
    spark = counts.sparkSession
    pointer = newest_pointer(spark, base)
    if pointer is not None and number <= pointer.content["batch"]:
        return
    days = dict(pointer.content["days"]) if pointer else {}
    fresh = counts.withColumn(DAY, F.date_format("window_start", "yyyy-MM-dd")).persist()
    touched = [row[DAY] for row in fresh.select(DAY).distinct().collect()]
    held = _read_days(spark, base, counts.schema, {d: days[d] for d in touched if d in days})
    merged = (
        held.unionByName(fresh)
        .groupBy(DAY, "window_start", "window_end", *by)
        .agg(F.sum("events").alias("events"))
    )
    version = pointer.number + 1 if pointer else 1
    (
        merged.hint("rebalance", DAY)
        .write.mode("overwrite")
        .partitionBy(DAY)
        .parquet(version_path(base, version))
    )
    fresh.unpersist()
    days.update(dict.fromkeys(touched, version))
    publish(spark, base, {"batch": number, "days": days})
    named = {(str(v), d) for p in kept_pointers(spark, base) for d, v in p.content["days"].items()}
    stale = set(partition_paths(spark, base, "version", DAY)) - named
    drop_partitions(spark, base, ("version", DAY), stale)


def _read_days(
    spark: SparkSession, base: str, schema: StructType, days: dict[str, int]
) -> DataFrame:
    """Days of a table of counts, each in its version; other folders are pruned."""
    if not days:
        return spark.createDataFrame([], StructType([*schema.fields, DAY_FIELD]))
    places = StructType([*schema.fields, StructField("version", IntegerType()), DAY_FIELD])
    by_version: dict[int, list[str]] = {}
    for day, version in days.items():
        by_version.setdefault(version, []).append(day)
    current = reduce(
        or_,
        ((F.col("version") == v) & F.col(DAY).isin(d) for v, d in by_version.items()),
    )
    return spark.read.schema(places).parquet(base).where(current).drop("version")


def read_counts(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The table that ``count_into`` fills, as of its newest batch."""
    pointer = newest_pointer(spark, base)
    days = pointer.content["days"] if pointer else {}
    return _read_days(spark, base, schema, days).drop(DAY)


def _run_batches(
    rows: DataFrame, checkpoint: str, do: Callable[[DataFrame, int], None]
) -> None:
    running = (
        rows.writeStream.foreachBatch(do)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()


# Rows that come too late for a stateful operator


def split_late(events: DataFrame, base: str, checkpoint: str, delay_seconds: int) -> None:
    """Write everything that is there under ``late=false`` and ``late=true``.

    A row is late if its time is before the watermark: the greatest time of the batches
    before it, less the delay. A pointer holds the watermark and the batch it includes,
    and a batch has a folder, so a repeated batch changes nothing. ``ROW`` tells rows
    apart that are equal.
    """
    spark = events.sparkSession

    def split(batch: DataFrame, number: int) -> None:
        pointer = newest_pointer(spark, base)
        if pointer is not None and number <= pointer.content["batch"]:
            return
        watermark = pointer.content["watermark"] if pointer else None
        time = F.unix_micros(TIME)
        is_late = F.lit(False) if watermark is None else F.coalesce(time < watermark, F.lit(False))
        named = F.concat_ws("-", F.lit(number), F.monotonically_increasing_id())
        path = f"{base}/batch={number}"
        marked = batch.withColumns({ROW: named, "late": is_late})
        marked.write.mode("overwrite").partitionBy("late").parquet(path)
        greatest = spark.read.schema(batch.schema).parquet(path).agg(F.max(time)).first()[0]
        reached = [] if greatest is None else [greatest - delay_seconds * 1_000_000]
        reached += [] if watermark is None else [watermark]
        publish(spark, base, {"batch": number, "watermark": max(reached, default=None)})

    _run_batches(events, checkpoint, split)


def dedup_available(
    events: DataFrame, base: str, delay_seconds: int, keys: Sequence[str] = ("event_id",)
) -> Deduplicated:
    """Deduplicate everything that is there; every row ends in one of three tables.

    Late rows are split off first: the operator that remembers keys would drop them
    without a trace. What it is given is never behind its own watermark, as that is
    taken from the same rows, later. Its state is on the executors' disks.
    """
    spark = events.sparkSession
    keep_state_on_disk(spark)
    split, unique = f"{base}/split", f"{base}/unique"
    split_late(events, split, f"{base}/state-split", delay_seconds)
    fields = [f for f in events.schema.fields if f.name not in (ROW, "late", "batch")]
    places = [StructField(n, t) for n, t in ((ROW, StringType()), ("batch", LongType()), ("late", BooleanType()))]
    schema = StructType([*fields, *places])
    on_time = open_files(spark, split, schema, files="*.parquet").where(~F.col("late"))
    kept = dedup_stream(on_time.drop("batch", "late"), f"{delay_seconds} seconds", keys)
    chosen = run_available(kept, unique, f"{base}/state-unique")
    landed = spark.read.schema(schema).parquet(split).drop("batch")
    late = landed.where("late").drop("late", ROW)
    others = landed.where("NOT late").drop("late").join(chosen.select(ROW), ROW, "left_anti")
    return Deduplicated(chosen.drop(ROW), others.drop(ROW), late)


@dataclass(frozen=True)
class Deduplicated:
    """The first copies, further copies, and rows that came behind the watermark."""

    unique: DataFrame
    duplicates: DataFrame
    late: DataFrame


def keep_state_on_disk(spark: SparkSession) -> None:
    """Let the streams started from now on keep state in RocksDB, not in the heap, and
    checkpoint what changed of it instead of all of it."""
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
