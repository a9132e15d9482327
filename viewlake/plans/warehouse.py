"""The star schema: dimensions with stable keys, facts and their checks.

The grain of ``fact_viewing`` is content, region, device and day. Key 0 of a
dimension stands for members it does not know, so no event is lost on the way
into the fact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewlake import schemas
from viewlake.functions import (
    calendar_columns,
    completed_views,
    date_key,
    exact_units,
    from_units,
    launch_delay_days,
    parse_date,
    round_half_up,
    watch_hours,
)
from viewlake.operators.enrich import merged_if_large, one_row_per_key
from viewlake.operators.keys import number_rows, stable_keys, upsert
from viewlake.sources.calendar import date_series

# First and last day of dim_date.
CALENDAR = (date(2020, 1, 1), date(2030, 12, 31))

UNKNOWN_KEY = 0
FACT_KEYS = ("content_key", "region_key", "device_key", "date_key")
CONTENT_ATTRIBUTES = ("title", "genre", "studio", "release_date", "content_type")

TABLES: dict[str, tuple[StructType, tuple[str, ...]]] = {
    "dim_date": (schemas.DIM_DATE, ()),
    "dim_content": (schemas.DIM_CONTENT, ()),
    "dim_region": (schemas.DIM_REGION, ()),
    "dim_device": (schemas.DIM_DEVICE, ()),
    "fact_viewing": (schemas.FACT_VIEWING, ("date_key",)),
    "fact_content_launch": (schemas.FACT_CONTENT_LAUNCH, ()),
}


def create_tables(spark: SparkSession, base: str, database: str = "default") -> None:
    """Declare six tables to be filled, each over one Parquet folder under ``base``.

    The tables of a lake have versions: ``refresh.declare_tables`` declares those.
    """
    for name, (schema, partitions) in TABLES.items():
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schema.toDDL()})"
            f" USING parquet{by} LOCATION '{base}/{name}'"
        )


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    schema, _ = TABLES[name]
    columns = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema
    )
    return spark.sql(f"SELECT {columns} WHERE false")


# Dimensions


def dim_date(
    spark: SparkSession, start: date = CALENDAR[0], end: date = CALENDAR[1]
) -> DataFrame:
    days = date_series(spark, start, end)
    columns = calendar_columns(F.col("calendar_date"))
    return days.select(*(column.alias(name) for name, column in columns.items()))


def dim_region(spark: SparkSession) -> DataFrame:
    # Region keys, codes and names.
    return spark.sql(
        "SELECT * FROM VALUES"
        " (1, 'UK', 'United Kingdom'),"
        " (2, 'US', 'United States'),"
        " (3, 'DE', 'Germany'),"
        " (4, 'JP', 'Japan')"
        " AS regions(region_key, region_code, region_name)"
    )


def dim_device(events: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Device types seen in events, numbered in a stable way."""
    keyed = stable_keys(existing, events, ["device_type"], "device_key")
    return keyed.select("device_key", "device_type")


def dim_content(
    metadata: DataFrame, run_at: datetime, existing: DataFrame | None = None
) -> DataFrame:
    """Current content attributes, type 1: changes overwrite.

    ``updated_at`` is the time of the run that last changed a row, so a rerun
    changes nothing. A content that left the metadata keeps its row.
    """
    current = _one_row_per_content(metadata)
    if existing is None:
        loaded = current.withColumn("updated_at", F.lit(run_at).cast("timestamp"))
        columns = schemas.DIM_CONTENT.fieldNames()
        return number_rows(loaded, ["content_id"], "content_key").select(*columns)
    existing = merged_if_large(existing)
    keyed = stable_keys(
        existing.select("content_id", "content_key"),
        current,
        ["content_id"],
        "content_key",
    )
    attributes = F.struct(*CONTENT_ATTRIBUTES)
    before = existing.select(
        "content_id", attributes.alias("_before"), F.col("updated_at").alias("_since")
    )
    unchanged = attributes.eqNullSafe(F.col("_before"))
    incoming = (
        current.join(keyed, "content_id")
        .join(before, "content_id", "left")
        .select(
            "content_key",
            "content_id",
            *CONTENT_ATTRIBUTES,
            F.when(unchanged, F.col("_since"))
            .otherwise(F.lit(run_at).cast("timestamp"))
            .alias("updated_at"),
        )
    )
    return upsert(existing, incoming, ["content_id"])


def _one_row_per_content(metadata: DataFrame) -> DataFrame:
    """Metadata with typed dates; of several rows for one content the greatest."""
    typed = metadata.withColumn(
        "release_date", parse_date(F.col("release_date").cast("string"))
    )
    known = typed.where(F.col("content_id").isNotNull())
    return one_row_per_key(known.select("content_id", *CONTENT_ATTRIBUTES), ["content_id"])


def with_unknown(dimension: DataFrame, key: str, label: str) -> DataFrame:
    """The dimension plus its row for unknown members."""
    kinds = dict(dimension.dtypes)
    row = ", ".join(
        f"CAST({UNKNOWN_KEY} AS {kinds[c]}) AS {c}"
        if c == key
        else f"'unknown' AS {c}"
        if c == label
        else f"CAST(NULL AS {kinds[c]}) AS {c}"
        for c in dimension.columns
    )
    return dimension.unionByName(dimension.sparkSession.sql(f"SELECT {row}"))


def load_dimensions(
    spark: SparkSession,
    events: DataFrame,
    metadata: DataFrame,
    run_at: datetime,
    existing: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    existing = existing or {}
    return {
        "dim_date": dim_date(spark),
        "dim_region": dim_region(spark),
        "dim_device": dim_device(events, existing.get("dim_device")),
        "dim_content": dim_content(metadata, run_at, existing.get("dim_content")),
    }


# History of a dimension (type 2)


def open_history(snapshot: DataFrame, effective: date) -> DataFrame:
    """The first versions: valid from the given day, still open."""
    return snapshot.withColumns(
        {
            "valid_from": F.lit(effective),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def apply_snapshot(
    history: DataFrame, snapshot: DataFrame, key: str, effective: date
) -> DataFrame:
    """Close the versions that a new snapshot changes and open new ones.

    Only current versions meet the snapshot, one row per member on both sides,
    so a member with a long history is no heavier than another. A member that
    left the snapshot is closed.
    """
    attributes = [c for c in snapshot.columns if c != key]
    closed = history.where(~F.col("is_current"))
    current = history.where("is_current")
    new = snapshot.select(key, F.struct(*attributes).alias("_new"))
    matched = current.join(new, key, "left")
    same = F.struct(*attributes).eqNullSafe(F.col("_new"))
    resolved = matched.withColumns(
        {
            "valid_to": F.when(~same, F.lit(effective)),
            "is_current": same,
        }
    ).drop("_new")
    known = current.select(key, F.struct(*attributes).alias("_old"))
    opened = (
        snapshot.join(known, key, "left")
        .where(~F.struct(*attributes).eqNullSafe(F.col("_old")))
        .drop("_old")
    )
    return closed.unionByName(resolved).unionByName(open_history(opened, effective))


# Facts


def fact_viewing(
    events: DataFrame, dimensions: dict[str, DataFrame], unknown: str = "keep"
) -> DataFrame:
    """Events at the daily grain on dimension keys.

    A missing completion rate counts as zero here. Events are summed by natural
    key before the key lookups, so the joins see the daily grain and not single
    events. ``unknown`` is "keep" for key 0 or "drop" for an inner lookup.
    """
    minutes = F.coalesce("watch_minutes", F.lit(0.0))
    rate = F.coalesce("completion_rate", F.lit(0.0))
    summed = (
        events.where(F.col("event_date").isNotNull())
        .groupBy("content_id", "region", "device_type", "event_date")
        .agg(
            F.count("*").alias("_views"),
            exact_units(minutes).alias("_minutes"),
            completed_views().alias("_completed"),
            exact_units(rate).alias("_rates"),
        )
    )
    keyed = _look_up(
        summed.withColumn("date_key", date_key(F.col("event_date"))),
        dimensions,
        unknown,
        ("dim_content", "content_key", "content_id", "content_id"),
        ("dim_region", "region_key", "region_code", "region"),
        ("dim_device", "device_key", "device_type", "device_type"),
    )
    if unknown == "drop":
        # Keys stand for natural keys one to one, so the rows are at the grain already.
        return keyed.select(*FACT_KEYS, *_fact_measures(F.col))
    return keyed.groupBy(*FACT_KEYS).agg(*_fact_measures(F.sum))


def _fact_measures(take: Callable[[str], Column]) -> list[Column]:
    total, views = from_units(take("_minutes")), take("_views")
    rate = round_half_up(from_units(take("_rates")) / views, 4)
    return [
        views.cast("int").alias("views"),
        total.alias("watch_minutes"),
        watch_hours(total).alias("watch_hours"),
        take("_completed").cast("int").alias("completed_views"),
        rate.alias("avg_completion_rate"),
    ]


def fact_content_launch(
    launches: DataFrame, dimensions: dict[str, DataFrame]
) -> DataFrame:
    """One row per content and region with planned and actual date keys.

    Launches of contents that the dimension lacks are left out, since key 0
    would break the grain; ``orphan_launches`` lists them.
    """
    keyed = _look_up(
        # An inner join may broadcast either side.
        merged_if_large(launches),
        dimensions,
        "drop",
        ("dim_content", "content_key", "content_id", "content_id"),
        ("dim_region", "region_key", "region_code", "region"),
    )
    return keyed.select(
        "content_key",
        "region_key",
        date_key(parse_date(F.col("planned_launch_date"))).alias("planned_date_key"),
        date_key(parse_date(F.col("actual_launch_date"))).alias("actual_date_key"),
        launch_delay_days().alias("delay_days"),
        F.col("launch_status").alias("status"),
    )


def orphan_launches(
    launches: DataFrame, dimensions: dict[str, DataFrame]
) -> DataFrame:
    known = merged_if_large(dimensions["dim_content"]).select("content_id")
    return launches.join(known, "content_id", "left_anti")


def _look_up(
    rows: DataFrame,
    dimensions: dict[str, DataFrame],
    unknown: str,
    *lookups: tuple[str, str, str, str],
) -> DataFrame:
    """Add each dimension's key by its natural key; a large dimension is merged."""
    if unknown not in ("keep", "drop"):
        raise ValueError("unknown must be 'keep' or 'drop'")
    how = "left" if unknown == "keep" else "inner"
    for table, key, natural, column in lookups:
        pairs = merged_if_large(dimensions[table]).select(
            F.col(key), F.col(natural).alias(f"_{natural}")
        )
        rows = rows.join(pairs, F.col(column) == F.col(f"_{natural}"), how).drop(
            f"_{natural}"
        )
        if unknown == "keep":
            rows = rows.withColumn(key, F.coalesce(key, F.lit(UNKNOWN_KEY)))
    return rows


# Reads and checks


def star_read(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """The fact with names instead of content, region and device keys."""
    return (
        fact.join(dimensions["dim_content"].select("content_key", "title"), "content_key")
        .join(
            dimensions["dim_region"].select("region_key", "region_name"), "region_key"
        )
        .join(
            dimensions["dim_device"].select("device_key", "device_type"), "device_key"
        )
        .select(
            "title",
            "region_name",
            "device_type",
            "date_key",
            "views",
            "watch_hours",
            "completed_views",
        )
    )


def warehouse_top(
    fact: DataFrame, dimensions: dict[str, DataFrame], k: int = 10
) -> DataFrame:
    """The k fact rows with the most watch hours, with content and region names.

    The keys break ties, so the k rows are always the same ones.
    """
    return (
        fact.where(F.col("watch_hours") > 0)
        .join(dimensions["dim_content"].select("content_key", "title"), "content_key")
        .join(
            dimensions["dim_region"].select("region_key", "region_name"), "region_key"
        )
        .orderBy(F.desc("watch_hours"), *FACT_KEYS)
        .limit(k)
        .select("region_name", "title", "watch_hours", "views", "completed_views")
    )


def views_by_calendar(
    fact: DataFrame, calendar: DataFrame, by: Sequence[str] = ("year", "week")
) -> DataFrame:
    """Views and hours along calendar attributes; the fact is summed per day first."""
    per_day = fact.groupBy("date_key").agg(
        F.sum("views").alias("views"),
        exact_units(F.col("watch_minutes")).alias("_minutes"),
    )
    return (
        per_day.join(calendar, "date_key")
        .groupBy(*by)
        .agg(
            F.sum("views").alias("views"),
            watch_hours(from_units(F.sum("_minutes"))).alias("watch_hours"),
        )
    )


def verify_warehouse(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Checks of grain and referential integrity as rows of
    ``check_name``, ``failures`` and ``passed``.

    One pass counts the fact rows of each grain key, which finds repeats, and
    looks up all four keys, which finds orphans.
    """
    rows = fact.groupBy(*FACT_KEYS).agg(F.count("*").alias("_rows"))
    missing: dict[str, Column] = {}
    for table, key in (
        ("dim_content", "content_key"),
        ("dim_region", "region_key"),
        ("dim_device", "device_key"),
        ("dim_date", "date_key"),
    ):
        known = dimensions[table].select(key, F.lit(True).alias(f"_known_{key}"))
        rows = rows.join(known, key, "left")
        absent = F.when(F.col(f"_known_{key}").isNull(), F.col("_rows"))
        missing[f"orphan_{key}"] = F.coalesce(F.sum(absent), F.lit(0))
    counts = rows.agg(
        F.count_if(F.col("_rows") > 1).alias("repeated_grain"),
        *(c.alias(name) for name, c in missing.items()),
    )
    return counts.unpivot(
        [], ["repeated_grain", *missing], "check_name", "failures"
    ).withColumn("passed", F.col("failures") == 0)
