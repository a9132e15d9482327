"""Versions of the reference tables, and the days that a change of them restates.

Each run reads metadata and launches once, sets broken rows aside and keeps the others,
one row a key, as a new version if anything differs from the version before. The run
joins that version, so all its tables see the same rows even if a file is replaced
meanwhile, and no join has to make keys unique again.

A pointer names the versions that the published events were joined with. What differs
between those and the current ones, by key and by a hash of the row, is looked up in the
daily aggregate, which has a row for each content, region, device and day instead of one
for each event. The days found are written again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewlake.operators.enrich import declare_unique, one_row_per_key
from viewlake.operators.fingerprint import fingerprint
from viewlake.operators.validate import (
    REASON,
    Rule,
    check,
    launch_rules,
    metadata_rules,
    rejected_rows,
    valid_rows,
)
from viewlake.plans.zones import Zones, read_if_filled, side_by_side
from viewlake.schemas import CONTENT_LAUNCH, CONTENT_METADATA
from viewlake.sinks.versions import (
    drop_versions,
    newest_pointer,
    newest_version,
    publish,
    version_path,
    write_version,
)
from viewlake.sources.paths import partition_dates
from viewlake.sources.raw import read_reference_rows

REPEATED = "REPEATED_KEY"


@dataclass(frozen=True, eq=False)
class Kind:
    name: str
    schema: StructType
    keys: tuple[str, ...]


METADATA = Kind("content_metadata", CONTENT_METADATA, ("content_id",))
LAUNCH = Kind("content_launch", CONTENT_LAUNCH, ("content_id", "region"))
KINDS = (METADATA, LAUNCH)


@dataclass(frozen=True)
class References:
    """The rows a run joins, and their versions."""

    metadata: DataFrame
    launch: DataFrame
    versions: dict[str, int]


def rules_of(kind: Kind) -> list[Rule]:
    return metadata_rules() if kind is METADATA else launch_rules()


def split_reference(rows: DataFrame, kind: Kind) -> tuple[DataFrame, DataFrame]:
    """(rows to join, one for each key; rejected rows with their reason).

    Of several sound rows with one key the greatest is joined, and the other ones that
    differ are rejected as repeated; exact copies are the row itself.
    """
    rules = rules_of(kind)
    checked = check(rows, rules)
    sound = valid_rows(checked, rules).select(*kind.schema.fieldNames())
    unique = one_row_per_key(sound, kind.keys).select(*kind.schema.fieldNames())
    others = [c for c in sound.columns if c not in kind.keys]
    chosen = unique.select(
        *(F.col(k).alias(f"_{k}") for k in kind.keys), F.struct(*others).alias("_chosen")
    )
    same_key = [F.col(k) == F.col(f"_{k}") for k in kind.keys]
    repeated = (
        sound.distinct()
        .join(chosen, same_key)
        .where(~F.struct(*others).eqNullSafe(F.col("_chosen")))
        .select(*sound.columns)
        .withColumn(REASON, F.lit(REPEATED))
    )
    broken = rejected_rows(checked, rules)
    return unique, broken.unionByName(repeated, allowMissingColumns=True)


def changed_keys(before: DataFrame, after: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys whose row differs, appeared or left; a row is compared by its hash."""

    def hashed(rows: DataFrame, name: str) -> DataFrame:
        others = [c for c in rows.columns if c not in keys]
        return rows.select(*keys, F.md5(F.to_json(F.struct(*others))).alias(name))

    both = hashed(before, "_before").join(hashed(after, "_after"), list(keys), "full")
    return both.where(~F.col("_before").eqNullSafe(F.col("_after"))).select(*keys)


def _base(zones: Zones, kind: Kind) -> str:
    return f"{zones.references}/{kind.name}"


def _read_version(spark: SparkSession, zones: Zones, kind: Kind, version: int) -> DataFrame:
    rows = spark.read.schema(kind.schema).parquet(version_path(_base(zones, kind), version))
    return declare_unique(rows, kind.keys)


def _take_in(spark: SparkSession, zones: Zones, kind: Kind, path: str) -> int:
    """The version that holds what the reference file says now.

    A fingerprint of all its rows, broken ones too, tells whether anything changed.
    """
    base, rejects = _base(zones, kind), f"{zones.reference_rejects}/{kind.name}"
    landed = read_reference_rows(spark, kind.schema, path)
    digest = [str(v) for v in fingerprint(landed, []).first()]
    taken = newest_pointer(spark, base)
    if taken is not None and taken.content["digest"] == digest:
        return taken.content["version"]
    rows, rejected = split_reference(landed, kind)
    version = write_version(rows, base)
    rejected.write.mode("overwrite").parquet(version_path(rejects, version))
    drop_versions(spark, rejects, version)
    publish(spark, base, {"version": version, "digest": digest})
    return version


def load_references(spark: SparkSession, zones: Zones) -> References:
    """Take in both tables; a broken row goes to the rejected references."""
    paths = {METADATA: zones.metadata, LAUNCH: zones.launch}
    versions: dict[str, int] = {}

    def take_in(kind: Kind) -> None:
        versions[kind.name] = _take_in(spark, zones, kind, paths[kind])

    side_by_side(*(partial(take_in, kind) for kind in KINDS))
    metadata, launch = (_read_version(spark, zones, k, versions[k.name]) for k in KINDS)
    return References(metadata, launch, versions)


def rejected_references(spark: SparkSession, zones: Zones, kind: Kind) -> DataFrame:
    """The rejected rows of the newest version of a reference table."""
    base = f"{zones.reference_rejects}/{kind.name}"
    return spark.read.parquet(version_path(base, newest_version(spark, base)))


def dates_to_restate(spark: SparkSession, zones: Zones, current: References) -> list[date]:
    """Published event dates that hold a key whose reference row has changed.

    Published events whose references are not known, as of a lake from before there
    were versions, are all restated once.
    """
    columns = "content_id STRING, region STRING, event_date DATE"
    daily = read_if_filled(spark, zones.daily, "event_date", columns)
    if daily is None:
        return []
    pointer = newest_pointer(spark, zones.references)
    if pointer is None:
        return partition_dates(spark, zones.enriched, "event_date")
    found: set[date] = set()
    for kind, rows in ((METADATA, current.metadata), (LAUNCH, current.launch)):
        version = pointer.content[kind.name]
        if version == current.versions[kind.name]:
            continue
        changed = changed_keys(_read_version(spark, zones, kind, version), rows, kind.keys)
        # One row a day is left of a hot content before it meets the changed keys.
        held = daily.select(*kind.keys, "event_date").distinct()
        dates = held.join(changed, list(kind.keys), "left_semi").select("event_date")
        found |= {row["event_date"] for row in dates.distinct().collect()}
    return sorted(found)


def mark_published(spark: SparkSession, zones: Zones, current: References) -> None:
    """Say that all published events are joined with these versions."""
    pointer = newest_pointer(spark, zones.references)
    if pointer is not None and pointer.content == current.versions:
        return
    publish(spark, zones.references, current.versions)
    for kind in KINDS:
        drop_versions(spark, _base(zones, kind), current.versions[kind.name])

