"""Published warehouse versions, restated days and rejected reference rows."""

import shutil
from datetime import date, datetime

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from viewlake.plans import daily_run, references, refresh
from viewlake.plans.zones import Zones
from viewlake.sinks import versions
from viewlake.sources import land_raw, testdata

RUN = datetime(2024, 3, 1)
TITLES = "content_id string, title string, genre string, studio string, release_date string, content_type string"
LAUNCHES = "content_id string, region string, planned_launch_date string, actual_launch_date string, launch_status string"


def write_references(spark, zones, titles, launches=()):
    rows = [(c, t, "g", "s", "2020-01-01", "movie") for c, t in titles]
    spark.createDataFrame(rows, TITLES).write.mode("overwrite").option("header", True).csv(zones.metadata)
    rows = [(c, r, "2024-01-01", d, "on_time") for c, r, d in launches]
    spark.createDataFrame(rows, LAUNCHES).coalesce(1).write.mode("overwrite").option("header", True).csv(zones.launch)


def view(n, content, day, **others):
    return {"event_id": f"E{n}", "content_id": content, "event_timestamp": datetime(2024, 1, day, 9), "ingest_date": date(2024, 1, day), **others}


@pytest.fixture(scope="module")
def first_lake(tmp_path_factory):
    """Where the lake after its first run is, for tests to copy."""
    return tmp_path_factory.mktemp("first") / "lake"


@pytest.fixture
def zones(spark, make_events, tmp_path, first_lake):
    if not first_lake.exists():
        made = Zones(str(first_lake))
        write_references(spark, made, [("M1", "One"), ("M2", "Two")])
        land_raw(
            make_events(view(1, "M1", 1), view(2, "M2", 1), view(3, "M1", 2), view(4, "M2", 3, region="JP"), view(5, "M9", 4)),
            made.raw_events,
        )
        daily_run.run_incremental(spark, made, "first", RUN)
    shutil.copytree(first_lake, tmp_path / "lake")
    return Zones(str(tmp_path / "lake"))


def titles(spark, zones):
    return rows_of(spark.read.parquet(zones.enriched), "event_id", "title")


def test_a_changed_title_rewrites_exactly_its_days(spark, zones):
    write_references(spark, zones, [("M1", "Uno"), ("M2", "Two")])
    run = daily_run.run_incremental(spark, zones, "second", RUN)
    assert run.ingest_dates == [] and run.event_dates == [date(2024, 1, 1), date(2024, 1, 2)]
    assert titles(spark, zones) == [("E1", "Uno"), ("E2", "Two"), ("E3", "Uno"), ("E4", "Two"), ("E5", None)]
    assert daily_run.run_incremental(spark, zones, "third", RUN).stages == []


def test_a_launch_that_arrives_late_rewrites_the_days_of_its_region(spark, zones):
    write_references(spark, zones, [("M1", "One"), ("M2", "Two")], [("M2", "JP", "2024-01-04")])
    run = daily_run.run_incremental(spark, zones, "second", RUN)
    assert run.event_dates == [date(2024, 1, 3)]
    rows = spark.read.parquet(zones.enriched).where("launch_delay_days IS NOT NULL")
    assert rows_of(rows, "event_id", "launch_delay_days") == [("E4", 3)]
    assert refresh.read_dimension(spark, zones, "fact_content_launch").count() == 1


def test_a_title_that_is_withdrawn_goes(spark, zones):
    write_references(spark, zones, [("M1", "One")])
    run = daily_run.run_incremental(spark, zones, "second", RUN)
    assert run.event_dates == [date(2024, 1, 1), date(2024, 1, 3)]
    assert titles(spark, zones)[1] == ("E2", None)


def test_a_run_that_breaks_off_restates_again(spark, zones, monkeypatch):
    write_references(spark, zones, [("M1", "Uno"), ("M2", "Two")])
    with monkeypatch.context() as broken:
        broken.setattr(daily_run, "aggregate_daily", None)
        with pytest.raises(TypeError):
            daily_run.run_incremental(spark, zones, "second", RUN)
    run = daily_run.run_incremental(spark, zones, "third", RUN)
    assert run.event_dates == [date(2024, 1, 1), date(2024, 1, 2)]
    assert titles(spark, zones)[0] == ("E1", "Uno")


def test_old_lakes_are_restated_once(spark, zones):
    """State from before there were versions is as good as none."""
    from viewlake.sources.paths import drop_folder

    for folder in (zones.references, zones.id_index, zones.reach):
        drop_folder(spark, folder)
    run = daily_run.run_incremental(spark, zones, "again", RUN, [date(2024, 1, 2)])
    assert run.event_dates == [date(2024, 1, d) for d in (1, 2, 3, 4)]
    assert len(titles(spark, zones)) == 5
    assert daily_run.run_incremental(spark, zones, "idle", RUN).stages == []


def star(spark, prefix=""):
    return spark.sql(
        f"SELECT title, region_code, device_type, year, views FROM {prefix}fact_viewing"
        f" JOIN {prefix}dim_content USING (content_key) JOIN {prefix}dim_region USING (region_key)"
        f" JOIN {prefix}dim_device USING (device_key) JOIN {prefix}dim_date USING (date_key)"
    )


def test_star_joins_keep_every_view(spark, zones):
    refresh.open_warehouse(spark, zones)
    assert star(spark).agg(F.sum("views")).first()[0] == 5
    assert rows_of(star(spark).where("title IS NULL"), "views") == [(1,)]
    assert all(r.passed for r in refresh.verify(spark, zones).collect())


def test_a_reader_between_runs_sees_one_run(spark, zones, make_events):
    refresh.open_warehouse(spark, zones)
    before = star(spark)
    wanted = rows_of(before)
    land_raw(make_events(view(6, "M1", 1, ingest_date=date(2024, 1, 9), device_type="tv")), zones.raw_events)
    daily_run.run_incremental(spark, zones, "second", RUN)
    assert rows_of(before) == wanted  # its files are there, and no others are seen
    refresh.open_warehouse(spark, zones)
    assert star(spark).agg(F.sum("views")).first()[0] == 6


def test_what_a_broken_run_wrote_is_not_seen(spark, zones, make_events, monkeypatch):
    wanted = rows_of(refresh.read_fact(spark, zones))
    land_raw(make_events(view(6, "M1", 1, ingest_date=date(2024, 1, 9), device_type="tv")), zones.raw_events)

    def refuse(*args):
        raise OSError("no space")

    with monkeypatch.context() as broken:
        broken.setattr(refresh, "publish", refuse)
        with pytest.raises(OSError):
            daily_run.run_incremental(spark, zones, "second", RUN)
    assert rows_of(refresh.read_fact(spark, zones)) == wanted
    assert refresh.read_dimension(spark, zones, "dim_device").where("device_type = 'tv'").count() == 0
    daily_run.run_incremental(spark, zones, "third", RUN)
    assert refresh.read_fact(spark, zones).agg(F.sum("views")).first()[0] == 6


def test_runs_declare_the_warehouse_in_their_database(spark, make_events, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    zones = Zones(str(tmp_path), database="published")
    write_references(spark, zones, [("M1", "One")])
    for day in (1, 2, 3):
        land_raw(make_events(view(day, "M1" if day < 3 else "M2", day)), zones.raw_events)
        daily_run.run_incremental(spark, zones, f"d{day}", RUN)
        assert star(spark, "published.").agg(F.sum("views")).first()[0] == day
    assert spark.table("published.fact_content_launch").count() == 0
    spark.sql("DROP DATABASE published CASCADE")


def test_days_of_the_fact_prune_other_folders(spark, zones, make_events):
    land_raw(make_events(view(6, "M1", 2, ingest_date=date(2024, 1, 9))), zones.raw_events)
    daily_run.run_incremental(spark, zones, "second", RUN)
    plan = refresh.read_fact(spark, zones)._jdf.queryExecution().executedPlan().toString()
    assert "version" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_pointers_are_whole_or_absent(spark, tmp_path):
    base = str(tmp_path / "t")
    assert versions.newest_pointer(spark, base) is None
    for n in range(4):
        assert versions.publish(spark, base, {"n": n}).number == n + 1
    assert [p.content["n"] for p in versions.kept_pointers(spark, base)] == [2, 3]
    (tmp_path / "t" / ".pointer-0000000005.json").write_text('{"n":')  # left by a broken run
    assert versions.newest_pointer(spark, base).content == {"n": 3}
    assert versions.publish(spark, base, {"n": 9}).number == 5


def test_broken_reference_rows_are_set_aside(spark, make_events, tmp_path):
    zones = Zones(str(tmp_path))
    (tmp_path / "raw" / "content_metadata").mkdir(parents=True)
    (tmp_path / "raw" / "content_launch").mkdir(parents=True)
    (tmp_path / "raw/content_metadata/m.csv").write_text(
        "content_id,title,genre,studio,release_date,content_type\n"
        "C1,short\nM1,One,g,s,2024-01-01,movie\nC2,T,g,s,2024-01-01,movie,more,fields\n"
        ",T,g,s,2024-01-01,movie\nM1,Zwei,g,s,2024-01-01,movie\nM1,One,g,s,2024-01-01,movie\n"
    )
    (tmp_path / "raw/content_launch/l.csv").write_text(
        "content_id,region,planned_launch_date,actual_launch_date,launch_status\n"
        "M1,UK,2024-01-01,2024-01-02,delayed\nM1,US,2024-01-01,,soon\nM1,DE\nM1,JP,2024-01-01,,\n"
    )
    land_raw(make_events(view(1, "M1", 1), view(2, "C1", 1)), zones.raw_events)
    daily_run.run_incremental(spark, zones, "first", RUN)
    assert titles(spark, zones) == [("E1", "Zwei"), ("E2", None)]
    rejected = references.rejected_references(spark, zones, references.METADATA)
    assert rows_of(rejected, "content_id", "title", "rejection_reason") == [
        ("C1", "short", "MALFORMED_ROW"), ("C2", "T", "MALFORMED_ROW"),
        ("M1", "One", "REPEATED_KEY"), (None, "T", "NULL_CONTENT_ID"),
    ]
    rejected = references.rejected_references(spark, zones, references.LAUNCH)
    assert rows_of(rejected, "region", "rejection_reason") == [
        ("DE", "MALFORMED_ROW"), ("US", "INVALID_LAUNCH_STATUS=soon"),
    ]


def test_broken_rows_that_come_later_are_set_aside_too(spark, zones):
    with open(f"{zones.metadata}/more.csv", "w") as file:
        file.write("content_id,title,genre,studio,release_date,content_type\nM3,short\n")
    run = daily_run.run_incremental(spark, zones, "second", RUN)
    assert run.event_dates == []  # no sound row has changed
    rejected = references.rejected_references(spark, zones, references.METADATA)
    assert rows_of(rejected, "content_id") == [("M3",)]


def test_joins_of_declared_tables_need_no_aggregate(spark):
    from viewlake.operators.enrich import declare_unique, enrich_with_metadata

    events, metadata = testdata.viewing_events(spark, SMALL), testdata.content_metadata(spark, SMALL)
    plain = enrich_with_metadata(events, metadata)
    declared = enrich_with_metadata(events, declare_unique(metadata, ["content_id"]))
    assert "Aggregate" in plain._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in declared._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(plain, "event_id", "title") == rows_of(declared, "event_id", "title")
