"""Table schemas, enum domains and the schema compatibility check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "STRING": StringType(),
    "DOUBLE": DoubleType(),
    "INT": IntegerType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
}


def _table(columns: str) -> StructType:
    """A schema from "name TYPE [NOT NULL], ...", without a running session."""
    schema = StructType()
    for column in columns.split(","):
        name, kind, *rest = column.split()
        schema = schema.add(name, _TYPES[kind], nullable=not rest)
    return schema


# Column names, types and nullability of the landed tables.
VIEWING_EVENTS = _table(
    "event_id STRING NOT NULL, customer_id STRING, content_id STRING,"
    " event_timestamp TIMESTAMP, region STRING, device_type STRING,"
    " event_type STRING, watch_minutes DOUBLE, completion_rate DOUBLE,"
    " subscription_type STRING"
)
CONTENT_METADATA = _table(
    "content_id STRING NOT NULL, title STRING, genre STRING, studio STRING,"
    " release_date STRING, content_type STRING"
)
CONTENT_LAUNCH = _table(
    "content_id STRING NOT NULL, region STRING, planned_launch_date STRING,"
    " actual_launch_date STRING, launch_status STRING"
)

# The star schema.
DIM_DATE = _table(
    "date_key INT NOT NULL, calendar_date DATE NOT NULL, day INT NOT NULL,"
    " week INT NOT NULL, month INT NOT NULL, year INT NOT NULL,"
    " day_of_week INT NOT NULL"
)
DIM_CONTENT = _table(
    "content_key INT NOT NULL, content_id STRING NOT NULL, title STRING,"
    " genre STRING, studio STRING, release_date DATE, content_type STRING,"
    " updated_at TIMESTAMP"
)
DIM_REGION = _table(
    "region_key INT NOT NULL, region_code STRING NOT NULL,"
    " region_name STRING NOT NULL"
)
DIM_DEVICE = _table(
    "device_key INT NOT NULL, device_type STRING NOT NULL"
)
FACT_VIEWING = _table(
    "content_key INT NOT NULL, region_key INT NOT NULL, device_key INT NOT NULL,"
    " date_key INT NOT NULL, views INT NOT NULL, watch_minutes DOUBLE NOT NULL,"
    " watch_hours DOUBLE NOT NULL, completed_views INT NOT NULL,"
    " avg_completion_rate DOUBLE"
)
FACT_CONTENT_LAUNCH = _table(
    "content_key INT NOT NULL, region_key INT NOT NULL,"
    " planned_date_key INT NOT NULL, actual_date_key INT, delay_days INT,"
    " status STRING"
)

# Enum domains.
REGIONS = ("UK", "US", "DE", "JP")
DEVICE_TYPES = ("web", "mobile", "tv", "console", "tablet")
EVENT_TYPES = ("play", "pause", "complete", "launch-view", "skip", "rewind")
SUBSCRIPTION_TYPES = ("free", "basic", "premium", "family")
LAUNCH_STATUSES = ("on_time", "delayed", "cancelled")

# Fixed value: a view with at least this completion rate counts as completed.
COMPLETED_AT = 0.95

CORRUPT_RECORD = "_corrupt_record"


@dataclass(frozen=True)
class SchemaDrift:
    """How an incoming schema differs from the one a table was built with."""

    added: tuple[str, ...]
    missing: tuple[str, ...]
    retyped: tuple[str, ...]

    @property
    def compatible(self) -> bool:
        """Added columns are safe; lost or retyped ones need a backfill."""
        return not self.missing and not self.retyped


def compare_schemas(expected: StructType, incoming: StructType) -> SchemaDrift:
    """Compare by column name; nullability is not compared, since file readers
    return every column as nullable."""
    want = {f.name: f.dataType for f in expected}
    have = {f.name: f.dataType for f in incoming}
    return SchemaDrift(
        added=tuple(n for n in have if n not in want),
        missing=tuple(n for n in want if n not in have),
        retyped=tuple(n for n in want if n in have and have[n] != want[n]),
    )


def require_compatible(expected: StructType, incoming: StructType) -> SchemaDrift:
    drift = compare_schemas(expected, incoming)
    if not drift.compatible:
        raise ValueError(
            f"incompatible schema: missing {list(drift.missing)},"
            f" retyped {list(drift.retyped)}, added {list(drift.added)}"
        )
    return drift
