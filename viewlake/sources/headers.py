"""Columns of landed CSV files, by name instead of by place.

Each dataset has a log of its columns. Before a run reads arrivals it looks at the header
of each ingest date: columns may stand in any order, and new ones are noted and left out,
but a column that is missing or has another name stops the run before it writes anything.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from viewlake.schemas import CORRUPT_RECORD, VIEWING_EVENTS, require_compatible
from viewlake.sinks.versions import newest_pointer, publish
from viewlake.sources.paths import first_line, one_file
from viewlake.sources.raw import raw_events_options


def columns_of(spark: SparkSession, base: str, day: date) -> tuple[str, ...]:
    """The header of one file of an ingest date; the reader checks the other files of the
    date against it. A date without rows has the columns of the schema."""
    file = one_file(spark, f"{base}/ingest_date={day.isoformat()}")
    line = first_line(spark, file) if file is not None else None
    return tuple(next(csv.reader([line]))) if line else tuple(VIEWING_EVENTS.fieldNames())


def _as_schema(columns: Iterable[str]) -> StructType:
    known = {f.name: f for f in VIEWING_EVENTS}
    return StructType([known.get(c, StructField(c, StringType())) for c in columns])


def read_landed_events(
    spark: SparkSession, base: str, ingest_dates: Iterable[date], log: str | None = None
) -> DataFrame:
    """The events of the ingest dates, with the columns of the schema.

    Dates with the same header are read together. ``log`` is where the columns are noted.
    """
    by_header: dict[tuple[str, ...], list[date]] = {}
    for day in sorted(ingest_dates):
        by_header.setdefault(columns_of(spark, base, day), []).append(day)
    drifts = {h: require_compatible(VIEWING_EVENTS, _as_schema(h)) for h in by_header}
    added = sorted({c for drift in drifts.values() for c in drift.added})
    if log is not None:
        _note_columns(spark, log, added)
    parts = [_read(spark, base, h, days) for h, days in by_header.items()]
    rows = parts[0] if parts else _read(spark, base, VIEWING_EVENTS.fieldNames(), [])
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _read(
    spark: SparkSession, base: str, header: Iterable[str], days: list[date]
) -> DataFrame:
    places = [StructField(CORRUPT_RECORD, StringType()), StructField("ingest_date", DateType())]
    schema = StructType([*_as_schema(header).fields, *places])
    rows = spark.read.schema(schema).options(**raw_events_options()).csv(base)
    wanted = [*VIEWING_EVENTS.fieldNames(), CORRUPT_RECORD, "ingest_date"]
    return rows.where(F.col("ingest_date").isin(days)).select(*wanted)


def known_columns(spark: SparkSession, log: str) -> list[str]:
    """The columns seen so far, those of the schema first."""
    pointer = newest_pointer(spark, log)
    return pointer.content["columns"] if pointer else []


def _note_columns(spark: SparkSession, log: str, added: list[str]) -> None:
    before = known_columns(spark, log) or VIEWING_EVENTS.fieldNames()
    columns = [*before, *(c for c in added if c not in before)]
    if columns != known_columns(spark, log):
        publish(spark, log, {"columns": columns})
