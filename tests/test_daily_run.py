from datetime import date, datetime, timedelta

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from viewlake.operators.fingerprint import (
    changed_partitions,
    compare_fingerprints,
    fingerprint,
)
from viewlake.plans import daily_run, references, refresh, warehouse
from viewlake.plans.zones import Zones
from viewlake.sources import land_raw, testdata
from viewlake.sources.paths import partition_paths

RUN = datetime(2024, 3, 1)
TABLES = ("enriched", "daily", "duplicates")


def new_lake(spark, path):
    zones = Zones(str(path))
    for frame, target in (
        (testdata.content_metadata(spark, SMALL), zones.metadata),
        (testdata.content_launch(spark, SMALL), zones.launch),
    ):
        frame.write.option("header", True).csv(target)
    return zones


def differing(spark, a, b, table):
    x = spark.read.parquet(getattr(a, table))
    y = spark.read.parquet(getattr(b, table)).select(x.columns)
    prints = (fingerprint(rows, ["event_date"]) for rows in (x, y))
    return rows_of(changed_partitions(compare_fingerprints(*prints, ["event_date"])))


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """One lake filled by a single run, one by three."""
    raw = testdata.raw_events(spark, SMALL)
    full = new_lake(spark, tmp_path_factory.mktemp("full"))
    land_raw(raw, full.raw_events)
    daily_run.run_incremental(spark, full, "full", RUN)
    steps = new_lake(spark, tmp_path_factory.mktemp("steps"))
    for n, (low, high) in enumerate(((1, 12), (13, 20), (21, 31))):
        days = (F.lit(date(2024, 1, d)) for d in (low, high))
        land_raw(raw.where(F.col("ingest_date").between(*days)), steps.raw_events)
        daily_run.run_incremental(spark, steps, f"s{n}", RUN + timedelta(days=n))
    return full, steps


@pytest.mark.parametrize("table", TABLES)
def test_steps_equal_one_run(spark, lakes, table):
    assert differing(spark, *lakes, table) == []


def test_steps_give_the_same_facts(spark, lakes):
    full, steps = (
        rows_of(
            warehouse.star_read(
                refresh.read_fact(spark, z), refresh.read_dimensions(spark, z)
            )
        )
        for z in lakes
    )
    assert full == steps
    assert sum(r[4] for r in full) == 990


def test_every_row_is_published_or_rejected(spark, lakes):
    for zones in lakes:
        checked = spark.read.parquet(zones.checked)
        assert checked.count() == 1009
        rejected = checked.where("status = 'rejected'").count()
        unique = spark.read.parquet(zones.enriched).count()
        duplicates = spark.read.parquet(zones.duplicates).count()
        assert rejected + unique + duplicates == 1009


def test_nothing_pending_does_nothing(spark, lakes):
    result = daily_run.run_incremental(spark, lakes[0], "idle", RUN)
    assert (result.ingest_dates, result.stages) == ([], [])


def test_checks_pass(spark, lakes):
    for zones in lakes:
        assert all(r.passed for r in refresh.verify(spark, zones).collect())


def test_rerun_changes_nothing(spark, lakes):
    full, steps = lakes
    result = daily_run.run_incremental(
        spark, steps, "again", RUN + timedelta(days=9), [date(2024, 1, 15)]
    )
    assert date(2024, 1, 15) in result.event_dates
    table = daily_run.compare_to_previous(spark, steps, "again")
    assert table.count() == len(result.event_dates)
    assert changed_partitions(table).count() == 0
    for name in TABLES:
        assert differing(spark, full, steps, name) == []
    assert daily_run.pending_dates(spark, steps) == []


def test_backfill_equals_full_recompute(spark, lakes):
    full, steps = lakes
    _, counts = daily_run.run_backfill(
        spark, steps, "fill", RUN + timedelta(days=10), "2024-01-29", "2024-02-01"
    )
    assert [r[1] for r in rows_of(counts)][2:] == [-1, -1]
    for name in TABLES:
        assert differing(spark, full, steps, name) == []


def event(n, when, arrived, **others):
    return {"event_id": n, "event_timestamp": when, "ingest_date": arrived, **others}


def test_late_copies_move_rows_between_days(spark, make_events, tmp_path):
    zones = new_lake(spark, tmp_path)
    d1, d2, d3 = (date(2024, 1, d) for d in (1, 2, 3))
    land_raw(
        make_events(event("x", datetime(2024, 1, 1, 23, 59), d1),
                    event("y", datetime(2024, 1, 1, 8), d1, region="US")),
        zones.raw_events,
    )
    daily_run.run_incremental(spark, zones, "1", RUN)
    # A newer copy of x falls on the next day, and a late event on the day before.
    land_raw(
        make_events(event("x", datetime(2024, 1, 2, 0, 1), d2),
                    event("z", datetime(2023, 12, 31, 9), d2)),
        zones.raw_events,
    )
    result = daily_run.run_incremental(spark, zones, "2", RUN + timedelta(days=1))
    assert result.event_dates == [date(2023, 12, 31), d1, d2]
    published = spark.read.parquet(zones.enriched)
    assert rows_of(published, "event_id", "event_date", "region") == [
        ("x", d2, "UK"), ("y", d1, "US"), ("z", date(2023, 12, 31), "UK"),
    ]
    assert rows_of(spark.read.parquet(zones.duplicates), "event_id", "event_date") == [
        ("x", d1)
    ]
    # An older copy arrives last and loses; the published rows stay.
    land_raw(
        make_events(event("x", datetime(2024, 1, 1, 5), d3)), zones.raw_events
    )
    daily_run.run_incremental(spark, zones, "3", RUN + timedelta(days=2))
    assert rows_of(spark.read.parquet(zones.enriched), "event_id", "event_date") == [
        ("x", d2), ("y", d1), ("z", date(2023, 12, 31)),
    ]
    assert spark.read.parquet(zones.duplicates).count() == 2
    fact = refresh.read_fact(spark, zones)
    assert fact.agg(F.sum("views")).first()[0] == 3


def test_a_failed_run_says_so_and_stays_pending(spark, make_events, tmp_path):
    zones = Zones(str(tmp_path))
    land_raw(make_events({}), zones.raw_events)
    with pytest.raises(Exception):
        daily_run.run_incremental(spark, zones, "broken", RUN)
    log = spark.read.parquet(zones.runs)
    assert dict(rows_of(log, "stage", "status")) == {
        "check": "success", "select": "success", "publish": "failed",
    }
    assert daily_run.pending_dates(spark, zones) == [date(2024, 1, 1)]
    for frame, target in (
        (testdata.content_metadata(spark, SMALL), zones.metadata),
        (testdata.content_launch(spark, SMALL), zones.launch),
    ):
        frame.write.option("header", True).csv(target)
    daily_run.run_incremental(spark, zones, "fixed", RUN + timedelta(days=1))
    assert spark.read.parquet(zones.enriched).count() == 1
    assert daily_run.pending_dates(spark, zones) == []


def test_arrivals_without_a_valid_row(spark, make_events, tmp_path):
    zones = new_lake(spark, tmp_path)
    land_raw(make_events({"region": "XX"}), zones.raw_events)
    result = daily_run.run_incremental(spark, zones, "1", RUN)
    assert result.event_dates == []
    assert spark.read.parquet(zones.checked).count() == 1
    assert daily_run.pending_dates(spark, zones) == []


def test_a_run_that_broke_off_late_is_made_good(
    spark, make_events, tmp_path, monkeypatch
):
    """The rows of a day become invalid, and the run breaks off after publishing."""
    zones = new_lake(spark, tmp_path)
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    land_raw(
        make_events(event("x", datetime(2024, 1, 1, 5), d1),
                    event("y", datetime(2024, 1, 2, 5), d2)),
        zones.raw_events,
    )
    daily_run.run_incremental(spark, zones, "1", RUN)
    real = daily_run.check_events
    stricter = lambda raw: real(
        raw.withColumn("region", F.when(F.col("event_id") != "x", F.col("region")))
    )
    monkeypatch.setattr(daily_run, "check_events", stricter)
    with monkeypatch.context() as broken:
        broken.setattr(daily_run, "aggregate_daily", None)
        with pytest.raises(TypeError):
            daily_run.run_incremental(spark, zones, "2", RUN, [d1])
    assert daily_run.pending_dates(spark, zones) == [d1]
    result = daily_run.run_incremental(spark, zones, "3", RUN)
    assert result.event_dates == [d1]
    for table in (zones.enriched, zones.daily):
        assert rows_of(spark.read.parquet(table), "event_date") == [(d2,)]
    fact = refresh.read_fact(spark, zones)
    assert rows_of(fact, "date_key") == [(20240102,)]


def test_declared_tables_follow_the_newest_version(spark, lakes):
    _, steps = lakes
    spark.sql("CREATE DATABASE IF NOT EXISTS declared")
    for _ in range(2):
        refresh.declare_tables(spark, steps, "declared")
        for name in ("dim_content", "dim_device", "dim_region", "dim_date"):
            newest = refresh.read_dimension(spark, steps, name)
            assert rows_of(spark.table(f"declared.{name}")) == rows_of(newest)
        fact = refresh.read_fact(spark, steps)
        assert rows_of(spark.table("declared.fact_viewing").select(fact.columns)) == rows_of(fact)
    spark.sql("DROP DATABASE declared CASCADE")


def test_unchanged_tables_are_not_rewritten_and_old_versions_go(spark, tmp_path):
    zones = Zones(str(tmp_path))
    base = f"{zones.warehouse}/dim_device"
    for names in (["a"], ["a"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c"]):
        rows = spark.createDataFrame(list(enumerate(names, 1)), "device_key int, device_type string")
        refresh.write_dimension(rows, zones, "dim_device")
    assert partition_paths(spark, base, "version") == [("2",), ("3",)]
    assert refresh.read_dimension(spark, zones, "dim_device").count() == 3


def test_a_content_that_becomes_known_restates_its_days(spark, make_events, tmp_path):
    zones, header = Zones(str(tmp_path)), ("header", True)
    columns = "content_id string, title string, genre string, studio string, release_date string, content_type string"

    def metadata(*ids):
        rows = spark.createDataFrame([(i, f"T{i}", "g", "s", "2020-01-01", "movie") for i in ids], columns)
        rows.write.mode("overwrite").option(*header).csv(zones.metadata)

    testdata.content_launch(spark, SMALL).write.option(*header).csv(zones.launch)
    days = [date(2024, 1, 1), date(2024, 1, 5)]
    events = [
        {"event_id": f"E{n}", "content_id": c, "event_timestamp": datetime(d.year, d.month, d.day, 9), "ingest_date": d}
        for n, (c, d) in enumerate((("M1", days[0]), ("M2", days[0]), ("M1", days[1])))
    ]
    metadata("M1")
    land_raw(make_events(*events[:2]), zones.raw_events)
    daily_run.run_incremental(spark, zones, "one", RUN)
    assert refresh.read_fact(spark, zones).where("content_key = 0").count() == 1
    metadata("M1", "M2")
    land_raw(make_events(events[2]), zones.raw_events)
    done = daily_run.run_incremental(spark, zones, "two", RUN)
    assert done.event_dates == days
    assert refresh.read_fact(spark, zones).where("content_key = 0").count() == 0
    assert rows_of(spark.read.parquet(zones.enriched), "event_id", "title") == [
        ("E0", "TM1"), ("E1", "TM2"), ("E2", "TM1"),
    ]
    current = references.load_references(spark, zones)
    assert references.dates_to_restate(spark, zones, current) == []
