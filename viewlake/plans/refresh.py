"""The written warehouse: versions of its tables, published together.

A run writes every table that changes as a new version next to the ones being read, the
fact only in the days that were rewritten. Then it publishes one pointer that names the
version of each table and of each day of the fact. Readers start from a pointer: they see
all tables as of one run, and what they began to read stays until two runs later.

Dimensions are written with their rows for unknown members, so a join in SQL keeps every
view. ``open_warehouse`` names the tables of a pointer as views of a session; a lake with
a database in its zones has them declared there after every run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.operators.fingerprint import fingerprint
from viewlake.plans import warehouse
from viewlake.plans.zones import Zones, side_by_side
from viewlake.schemas import FACT_VIEWING
from viewlake.sinks.versions import (
    Pointer,
    drop_versions,
    kept_pointers,
    newest_pointer,
    newest_version,
    publish,
    version_path,
)
from viewlake.sources.paths import drop_folder, drop_partitions, partition_paths
from viewlake.sources.raw import read_content_launch, read_content_metadata

DIMENSIONS = ("dim_date", "dim_region", "dim_device", "dim_content")
FACT = "fact_viewing"
UNKNOWN_LABELS = {
    "dim_content": ("content_key", "content_id"),
    "dim_region": ("region_key", "region_code"),
    "dim_device": ("device_key", "device_type"),
}


def _base(zones: Zones, name: str) -> str:
    return f"{zones.warehouse}/{name}"


# Reading


def read_dimension(
    spark: SparkSession, zones: Zones, name: str, pointer: Pointer | None = None
) -> DataFrame | None:
    """A small warehouse table as published, or its newest complete version while
    nothing has been published."""
    pointer = pointer or newest_pointer(spark, zones.warehouse)
    if pointer is not None:
        version = pointer.content["tables"].get(name, 0)
    else:
        version = newest_version(spark, _base(zones, name))
    if not version:
        return None
    schema, _ = warehouse.TABLES[name]
    return spark.read.schema(schema).parquet(version_path(_base(zones, name), version))


def read_dimensions(
    spark: SparkSession, zones: Zones, unknown: bool = True
) -> dict[str, DataFrame]:
    """All dimensions, with their rows for unknown members unless told otherwise."""
    tables = {}
    for name in DIMENSIONS:
        rows = read_dimension(spark, zones, name)
        if rows is not None:
            tables[name] = rows if unknown else _members(rows, name)
    return tables


def _members(rows: DataFrame, name: str) -> DataFrame:
    if name not in UNKNOWN_LABELS:
        return rows
    return rows.where(F.col(UNKNOWN_LABELS[name][0]) != warehouse.UNKNOWN_KEY)


def read_fact(
    spark: SparkSession, zones: Zones, pointer: Pointer | None = None
) -> DataFrame | None:
    """The fact as published, each day in its version, None before the first run."""
    pointer = pointer or newest_pointer(spark, zones.warehouse)
    if pointer is None:
        return None
    days = pointer.content["days"]
    schema = f"{FACT_VIEWING.toDDL()}, version INT"
    rows = spark.read.schema(schema).parquet(_base(zones, FACT)) if days else None
    if rows is None:
        return warehouse.empty_table(spark, FACT)
    return rows.where(_published_days(days)).drop("version")


def _published_days(days: dict[str, int]) -> str:
    """A condition on the partition columns alone, so that other folders are pruned."""
    by_version: dict[int, list[str]] = {}
    for key, version in sorted(days.items()):
        by_version.setdefault(version, []).append(key)
    return " OR ".join(
        f"(version = {version} AND date_key IN ({', '.join(keys)}))"
        for version, keys in sorted(by_version.items())
    )


def open_warehouse(spark: SparkSession, zones: Zones) -> int:
    """Name the six tables as views of this session, all as of the newest run, and
    return the number of its pointer."""
    pointer = newest_pointer(spark, zones.warehouse)
    if pointer is None:
        raise LookupError("no run has published a warehouse yet")
    for name in warehouse.TABLES:
        if name == FACT:
            rows = read_fact(spark, zones, pointer)
        else:
            rows = read_dimension(spark, zones, name, pointer)
        if rows is None:
            rows = warehouse.empty_table(spark, name)
        rows.createOrReplaceTempView(name)
    return pointer.number


def declare_tables(spark: SparkSession, zones: Zones, database: str = "default") -> None:
    """Declare the six tables as views over what the newest run has published.

    A run does this itself where ``zones.database`` is set. Each view is replaced as a
    whole and names folders that stay until two runs later.
    """
    pointer = newest_pointer(spark, zones.warehouse)
    if pointer is None:
        return
    for name, (schema, _) in warehouse.TABLES.items():
        columns = ", ".join(schema.fieldNames())
        base, chosen = _base(zones, name), "false"
        if name == FACT:
            chosen = _published_days(pointer.content["days"]) or "false"
        elif name in pointer.content["tables"]:
            base, chosen = version_path(base, pointer.content["tables"][name]), "true"
        if chosen == "false":
            source = _typed_nothing(name)
        else:
            source = f"SELECT {columns} FROM parquet.`{base}` WHERE {chosen}"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {source}")


def _typed_nothing(name: str) -> str:
    schema, _ = warehouse.TABLES[name]
    columns = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema
    )
    return f"SELECT {columns} WHERE false"


# Writing


def write_dimension(rows: DataFrame, zones: Zones, name: str) -> int:
    """Write the next version next to the one that is being read, and return the version
    that holds the rows: the one before if nothing changed, whose copy is removed.

    Rows are computed once and compared as files. The version before stays for readers
    that have begun; older ones are removed.
    """
    spark, base = rows.sparkSession, _base(zones, name)
    before = newest_version(spark, base)
    version = before + 1
    rows.write.mode("overwrite").parquet(version_path(base, version))
    if before and _are_equal(spark, name, version_path(base, before), version_path(base, version)):
        drop_folder(spark, version_path(base, version))
        return before
    named = {p.content["tables"].get(name) for p in kept_pointers(spark, zones.warehouse)}
    drop_versions(spark, base, version - 1, named)
    return version


def _are_equal(spark: SparkSession, name: str, *paths: str) -> bool:
    """Whether two files of a table hold the same rows, by their fingerprints."""
    schema, _ = warehouse.TABLES[name]
    sides = [
        spark.read.schema(schema).parquet(path).withColumn("_side", F.lit(n))
        for n, path in enumerate(paths)
    ]
    prints = fingerprint(sides[0].unionByName(sides[1]), ["_side"]).drop("_side").collect()
    empty = [side.isEmpty() for side in sides] if len(prints) < 2 else [False, False]
    return all(empty) or (len(prints) == 2 and prints[0] == prints[1])


def _write_fact(rows: DataFrame, zones: Zones, version: int) -> set[str]:
    """Write days of the fact as a version and return those that have rows."""
    path = version_path(_base(zones, FACT), version)
    (
        rows.hint("rebalance", "date_key")
        .write.mode("overwrite")
        .partitionBy("date_key")
        .parquet(path)
    )
    return {key for (key,) in partition_paths(rows.sparkSession, path, "date_key")}


def refresh_warehouse(
    spark: SparkSession,
    zones: Zones,
    events: DataFrame,
    event_dates: Sequence[date],
    run_at: datetime,
    metadata: DataFrame | None = None,
    launch: DataFrame | None = None,
) -> None:
    """Extend the dimensions, write the fact of the given event dates and publish.

    ``events`` are all published events of those dates, so their days are replaced as a
    whole and a rerun leaves no trace. What a broken run wrote is not in a pointer and
    is written over.
    """
    if metadata is None:
        metadata = read_content_metadata(spark, zones.metadata)
    if launch is None:
        launch = read_content_launch(spark, zones.launch)
    pointer = newest_pointer(spark, zones.warehouse)
    existing = read_dimensions(spark, zones, unknown=False)
    fresh = warehouse.load_dimensions(spark, events, metadata, run_at, existing)
    tables = dict(pointer.content["tables"]) if pointer else {}

    def write(name: str, rows: DataFrame) -> None:
        if name in UNKNOWN_LABELS:
            rows = warehouse.with_unknown(rows, *UNKNOWN_LABELS[name])
        tables[name] = write_dimension(rows, zones, name)

    side_by_side(
        *(
            lambda n=name, r=rows: write(n, r)
            for name, rows in fresh.items()
            if name not in ("dim_date", "dim_region") or name not in existing
        )
    )
    known = {
        name: _members(
            spark.read.schema(warehouse.TABLES[name][0]).parquet(
                version_path(_base(zones, name), tables[name])
            ),
            name,
        )
        for name in DIMENSIONS
    }
    version = pointer.number + 1 if pointer else 1
    keys = {d.strftime("%Y%m%d") for d in event_dates}
    days = dict(pointer.content["days"]) if pointer else {}

    def write_fact() -> None:
        written = _write_fact(warehouse.fact_viewing(events, known), zones, version)
        for key in keys - written:
            days.pop(key, None)
        days.update(dict.fromkeys(written, version))

    side_by_side(
        write_fact,
        lambda: write("fact_content_launch", warehouse.fact_content_launch(launch, known)),
    )
    publish(spark, zones.warehouse, {"tables": tables, "days": days})
    _drop_unnamed_days(spark, zones)
    if zones.database:
        declare_tables(spark, zones, zones.database)


def _drop_unnamed_days(spark: SparkSession, zones: Zones) -> None:
    """Remove the days of the fact that no kept pointer names."""
    kept = kept_pointers(spark, zones.warehouse)
    named = {(str(v), d) for p in kept for d, v in p.content["days"].items()}
    base = _base(zones, FACT)
    held = partition_paths(spark, base, "version", "date_key")
    drop_partitions(spark, base, ("version", "date_key"), set(held) - named)


def verify(spark: SparkSession, zones: Zones) -> DataFrame | None:
    """The checks on exactly the tables that SQL reads."""
    fact = read_fact(spark, zones)
    if fact is None:
        return None
    return warehouse.verify_warehouse(fact, read_dimensions(spark, zones))
