from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from viewlake.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("tables")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_events(spark):
    """Build events from a few fields; the others get good values."""
    from viewlake.schemas import VIEWING_EVENTS
    from pyspark.sql.types import DateType, StructType

    good = {
        "event_id": "E1",
        "customer_id": "C1",
        "content_id": "M1",
        "event_timestamp": datetime(2024, 1, 1, 10, 0),
        "region": "UK",
        "device_type": "web",
        "event_type": "play",
        "watch_minutes": 60.0,
        "completion_rate": 0.5,
        "subscription_type": "free",
        "ingest_date": None,
    }
    fields = [f.dataType for f in VIEWING_EVENTS]
    schema = StructType()
    for name, kind in zip(VIEWING_EVENTS.fieldNames(), fields):
        schema = schema.add(name, kind)
    schema = schema.add("ingest_date", DateType())

    def build(*rows: dict):
        filled = []
        for row in rows:
            values = {**good, **row}
            if values["ingest_date"] is None and values["event_timestamp"]:
                values["ingest_date"] = values["event_timestamp"].date()
            filled.append(tuple(values[n] for n in schema.fieldNames()))
        return spark.createDataFrame(filled, schema)

    return build


def rows_of(frame, *columns):
    """Rows as sorted tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
