"""The raw zone: CSV under ``ingest_date=YYYY-MM-DD/``, never changed once landed."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from viewlake.schemas import (
    CONTENT_LAUNCH,
    CONTENT_METADATA,
    CORRUPT_RECORD,
    VIEWING_EVENTS,
)
from viewlake.sources.paths import (
    drop_folder,
    move_folder,
    partition_dates,
    partition_paths,
)

# Seconds with an optional fraction, then the zone offset.
READ_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"
WRITE_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Fixed value: the folder of rows whose partition column is NULL.
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# RFC 4180: a header, quotes doubled inside quoted fields.
CSV_TEXT = {"header": True, "quote": '"', "escape": '"'}


def raw_events_schema() -> StructType:
    """The event columns plus the raw text of broken rows and the partition."""
    return StructType(
        [
            *VIEWING_EVENTS.fields,
            StructField(CORRUPT_RECORD, StringType()),
            StructField("ingest_date", DateType()),
        ]
    )


def raw_events_options() -> dict[str, object]:
    """How landed events are read, by a batch and by a stream."""
    return {
        **CSV_TEXT,
        "enforceSchema": False,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_RECORD,
        "timestampFormat": READ_TIMESTAMP,
    }


def read_viewing_events(
    spark: SparkSession,
    base: str,
    ingest_dates: Iterable[date] | None = None,
) -> DataFrame:
    """Read landed events, all of them or the given ingest dates.

    The base path is read, so that ``ingest_date`` is a partition column and
    the date filter prunes folders. Rows that do not fit the schema are kept
    with NULLs and their text in ``_corrupt_record``.
    """
    events = (
        spark.read.schema(raw_events_schema())
        .options(**raw_events_options())
        .csv(base)
    )
    if ingest_dates is None:
        return events
    return events.where(F.col("ingest_date").isin(list(ingest_dates)))


def read_content_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Rows that fit the schema; ``plans.references`` sets the others aside."""
    return _fitting(read_reference_rows(spark, CONTENT_METADATA, path))


def read_content_launch(spark: SparkSession, path: str) -> DataFrame:
    return _fitting(read_reference_rows(spark, CONTENT_LAUNCH, path))


def _fitting(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT_RECORD).isNull()).drop(CORRUPT_RECORD)


def read_reference_rows(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """All rows of a reference table; its header must have the schema's columns in order.

    The text of a row with too few or too many fields is in ``_corrupt_record``. All
    columns are parsed, as a row is only found short if its last field is asked for.
    """
    fields = StructType([*schema.fields, StructField(CORRUPT_RECORD, StringType())])
    return (
        spark.read.schema(fields)
        .options(**CSV_TEXT)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .option("columnPruning", False)
        .csv(path)
    )


def land_raw(events: DataFrame, base: str) -> list[date]:
    """Write events under their ``ingest_date`` and return the dates landed.

    Raw data is immutable: a date that has already landed is refused. The rows are
    computed once, into a folder next to the raw zone, and the folders of their dates
    are then moved into place; before that nothing of them is seen.
    """
    spark = events.sparkSession
    staged = f"{base.rstrip('/')}-landing-{uuid.uuid4().hex[:12]}"
    try:
        (
            events.hint("rebalance", "ingest_date")
            .write.partitionBy("ingest_date")
            .options(**CSV_TEXT)
            .option("timestampFormat", WRITE_TIMESTAMP)
            .csv(staged)
        )
        texts = [text for (text,) in partition_paths(spark, staged, "ingest_date")]
        if NO_PARTITION in texts:
            raise ValueError("rows without an ingest_date cannot be landed")
        days = partition_dates(spark, staged, "ingest_date")
        taken = sorted(set(days) & set(partition_dates(spark, base, "ingest_date")))
        if taken:
            raise FileExistsError(f"already landed: {[d.isoformat() for d in taken]}")
        for text in texts:
            move_folder(spark, f"{staged}/ingest_date={text}", base)
    finally:
        drop_folder(spark, staged)
    return sorted(days)
