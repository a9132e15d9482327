from datetime import date, datetime

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from viewlake.functions import normalize_timestamps
from viewlake.operators import lateness
from viewlake.operators.fingerprint import (
    changed_partitions,
    compare_fingerprints,
    fingerprint,
)
from viewlake.operators.validate import valid_rows
from viewlake.plans.transform import check_events
from viewlake.sources import testdata
from viewlake.sources.paths import dates_frame


def test_ranges():
    parse = lateness.parse_date_range
    assert parse("2024-01-05", "2024-01-05") == [date(2024, 1, 5)]
    assert len(parse("2024-02-27", "2024-03-01")) == 4
    assert parse("2024-01-30", today=date(2024, 2, 1))[-1] == date(2024, 2, 1)
    assert parse("all") == []
    with pytest.raises(ValueError):
        parse("2024-01-02", "2024-01-01")


def test_new_dates_and_window(spark):
    raw = dates_frame(spark, [date(2024, 1, d) for d in (1, 2, 3)], "ingest_date")
    done = dates_frame(spark, [date(2024, 1, 1), date(2024, 1, 2)], "ingest_date")
    none = dates_frame(spark, [], "ingest_date")
    assert rows_of(lateness.new_partitions(raw, done)) == [(date(2024, 1, 3),)]
    assert lateness.new_partitions(none, done).count() == 0
    assert lateness.new_partitions(raw, none).count() == 3
    assert rows_of(lateness.late_window(done, date(2024, 1, 4))) == [(date(2024, 1, 2),)]


def test_late_events_and_the_dates_they_touch(spark, make_events):
    arrived = date(2024, 1, 10)
    rows = normalize_timestamps(
        make_events(
            {"event_id": "a", "event_timestamp": datetime(2024, 1, 10, 1)},
            {"event_id": "b", "event_timestamp": datetime(2024, 1, 7, 1)},
            {"event_id": "c", "event_timestamp": datetime(2023, 1, 1, 1)},
            {"event_id": "d", "event_timestamp": None, "ingest_date": arrived},
        ).withColumn("ingest_date", F.lit(arrived))
    )
    assert rows_of(lateness.late_events(rows), "event_id") == [("b",), ("c",)]
    assert rows_of(lateness.affected_dates(rows), "event_date", "arrived_rows") == [
        (date(2023, 1, 1), 1), (date(2024, 1, 7), 1), (date(2024, 1, 10), 1),
    ]
    valid = valid_rows(check_events(testdata.raw_events(spark, SMALL)))
    assert lateness.late_events(valid).count() == 5


def test_backfill_counts(spark, make_events):
    rows = make_events({}, {}, {"event_timestamp": datetime(2024, 1, 3)})
    table = lateness.backfill_range(spark, rows, date(2024, 1, 1), date(2024, 1, 3))
    assert [r[1] for r in rows_of(table)] == [2, -1, 1]


@pytest.mark.parametrize("digest", ["xxhash64", "md5"])
def test_fingerprints(make_events, digest):
    base = [{"event_id": str(i), "region": "UK" if i % 2 else "US"} for i in range(20)]
    before = fingerprint(make_events(*base), ["region"], digest=digest)

    def changed(rows):
        after = fingerprint(rows, ["region"], digest=digest)
        table = compare_fingerprints(before, after, ["region"])
        return rows_of(changed_partitions(table), "region")

    assert changed(make_events(*base[::-1]).repartition(3)) == []
    assert changed(make_events(*base[:-1], {**base[-1], "watch_minutes": 61.0})) == [("UK",)]
    # A NULL that moves to another column, and a pair of extra equal rows.
    swapped = {**base[0], "customer_id": None}
    other = {**base[0], "content_id": None}
    one = fingerprint(make_events(swapped), ["region"], digest=digest)
    two = fingerprint(make_events(other), ["region"], digest=digest)
    assert rows_of(one) != rows_of(two)
    assert changed(make_events(*base, base[0], base[0])) == [("US",)]
    assert changed(make_events(*base, {"region": "DE"})) == [("DE",)]


@pytest.mark.parametrize("digest", ["xxhash64", "md5"])
def test_values_do_not_run_into_each_other(spark, digest):
    def digest_of(*values):
        rows = spark.createDataFrame([(1, *values)], "p int, a string, b string, x double")
        return rows_of(fingerprint(rows, ["p"], digest=digest))

    assert digest_of("a|b", "c", 1.0) != digest_of("a", "b|c", 1.0)
    assert digest_of("a1:b", "c", 1.0) != digest_of("a", "b1:c", 1.0)
    assert digest_of(None, "c", 1.0) != digest_of("~", "c", 1.0)
    assert digest_of("a", "c", 1e-9) != digest_of("a", "c", 2e-9)
    assert digest_of("a", "c", 1e30) != digest_of("a", "c", float("nan"))


def test_unknown_digest(make_events):
    with pytest.raises(ValueError):
        fingerprint(make_events({}), ["region"], digest="crc")
