"""Inputs that used to be cut, shifted or dropped."""

from datetime import date, datetime

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from viewlake.plans import daily_run
from viewlake.plans.zones import Zones
from viewlake.schemas import VIEWING_EVENTS
from viewlake.sources import land_raw, testdata
from viewlake.sources.raw import read_content_metadata, read_viewing_events
from viewlake.streaming import open_raw_events, run_available


def test_long_ids_stay_distinct(spark):
    numbers = [1, 99_999, 100_000, 150_000, 150_001, 1_234_567_890, 1_234_567_891]
    events = spark.createDataFrame(
        [(n, datetime(2024, 1, 1), n, "click", 1.0, f'{{"item": {n}}}') for n in numbers],
        "event_id long, ts timestamp, user_id long, event_type string, value double,"
        " props string",
    )
    mapped = testdata.map_events(events)
    for column in ("event_id", "customer_id", "content_id"):
        assert mapped.select(column).distinct().count() == len(numbers)
    assert mapped.where("customer_id = 'CUST-00001'").count() == 1


def test_every_part_is_a_content(spark):
    parts = testdata.read_table(spark, SMALL, "part")
    kept = parts.where("p_partkey % 23 <> 22").count()
    assert testdata.content_metadata(spark, SMALL).count() == kept
    assert testdata.content_launch(spark, SMALL).count() == 4 * parts.count()


def test_quotes_and_commas_in_titles(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "content_id,title,genre,studio,release_date,content_type\n"
        'C1,"He said ""hi"", then left",g,s,2024-01-01,movie\n'
    )
    row = read_content_metadata(spark, str(tmp_path)).first()
    assert (row["title"], row["genre"]) == ('He said "hi", then left', "g")


def test_columns_in_another_order_are_refused(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "title,content_id,genre,studio,release_date,content_type\nT,C1,g,s,2024-01-01,m\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        read_content_metadata(spark, str(tmp_path)).collect()


def test_events_come_back_as_landed(spark, make_events, tmp_path):
    events = make_events({"customer_id": 'a "b", c'}, {"event_id": "E2"})
    land_raw(events, str(tmp_path / "raw"))
    back = read_viewing_events(spark, str(tmp_path / "raw")).select(events.columns)
    assert rows_of(back) == rows_of(events)


def test_stream_and_batch_read_the_same_rows(spark, make_events, tmp_path):
    odd = ['a "b", c', "", "x\\", "\\\"y", "tab\there", "'"]
    events = make_events(*({"event_id": f"E{n}", "customer_id": c} for n, c in enumerate(odd)))
    land_raw(events, str(tmp_path / "raw"))
    names = ",".join(VIEWING_EVENTS.fieldNames())
    lines = [names, "E8,too,few", "E9" + ",x" * 12, 'E10,"q ""r"", s",M1' + "," * 7]
    (tmp_path / "raw" / "ingest_date=2024-01-01" / "more.csv").write_text("\n".join(lines))
    batch = read_viewing_events(spark, str(tmp_path / "raw"))
    stream = run_available(
        open_raw_events(spark, str(tmp_path / "raw")), str(tmp_path / "o"), str(tmp_path / "s")
    )
    assert rows_of(stream, *batch.columns) == rows_of(batch)
    assert set(odd[:1] + odd[2:] + ['q "r", s']) <= {r[0] for r in rows_of(batch, "customer_id")}


def test_rows_without_ingest_date_are_refused(make_events, tmp_path):
    events = make_events({"event_id": "E1"}).withColumn(
        "ingest_date", F.lit(None).cast("date")
    )
    with pytest.raises(ValueError):
        land_raw(events, str(tmp_path / "raw"))
    assert not (tmp_path / "raw").exists()


def lake(spark, path):
    zones = Zones(str(path))
    for frame, target in (
        (testdata.content_metadata(spark, SMALL), zones.metadata),
        (testdata.content_launch(spark, SMALL), zones.launch),
    ):
        frame.write.option("header", True).csv(target)
    return zones


def test_an_older_copy_that_arrives_late_replaces_nothing(spark, make_events, tmp_path):
    zones = lake(spark, tmp_path)
    for day, hour in ((1, 12), (10, 10)):
        events = make_events(
            {
                "event_id": "X",
                "event_timestamp": datetime(2024, 1, 1, hour),
                "ingest_date": date(2024, 1, day),
            }
        )
        land_raw(events, zones.raw_events)
        daily_run.run_incremental(spark, zones, f"d{day}", datetime(2024, 2, day))
    hours = {
        name: [
            r["event_timestamp"].hour
            for r in spark.read.parquet(getattr(zones, name)).collect()
        ]
        for name in ("enriched", "duplicates")
    }
    assert hours == {"enriched": [12], "duplicates": [10]}


def test_backfill_of_dates_that_never_landed(spark, make_events, tmp_path):
    zones = lake(spark, tmp_path)
    land_raw(make_events({"ingest_date": date(2024, 1, 5)}), zones.raw_events)
    _, rows = daily_run.run_backfill(
        spark, zones, "b", datetime(2024, 2, 1), "2024-01-01", "2024-01-02"
    )
    assert [r["rows"] for r in rows.orderBy("ingest_date").collect()] == [-1, -1]
