"""Point-in-time joins, merged files, columns by name, stream logs."""

from datetime import date, datetime

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from viewlake.functions import normalize_timestamps
from viewlake.operators.asof import as_of_join
from viewlake.operators.fingerprint import fingerprint
from viewlake.plans import daily_run
from viewlake.plans.zones import Zones
from viewlake.schemas import VIEWING_EVENTS
from viewlake.sinks import partition_report
from viewlake.sinks.compaction import compact
from viewlake.sources import testdata
from viewlake.sources.headers import known_columns, read_landed_events
from viewlake.streaming import count_into, open_files
from viewlake.streaming.progress import BatchLog


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


VERSIONS = [
    ("a", at(1), at(5), "a1"), ("a", at(5), None, "a5"), ("a", at(9), at(10), "a9"),
    ("b", at(3), None, "b3"), ("b", at(3), None, "b3x"), (None, at(1), None, "none"), ("d", None, None, "never"),
]
EVENTS = [
    (1, "a", at(1)), (2, "a", at(4, 23)), (3, "a", at(5)), (4, "a", at(9, 5)), (5, "a", at(12)),
    (6, "b", at(2)), (7, "b", at(3)), (8, "c", at(4)), (9, None, at(4)), (10, "a", None), (3, "a", at(5)),
    (11, "d", at(6)), (12, "a", datetime(2023, 12, 31)),
]
WANTED = {1: "a1", 2: "a1", 3: "a5", 4: "a9", 5: None, 6: None, 7: "b3x", 8: None, 9: None, 10: None, 11: None, 12: None}


@pytest.mark.parametrize("period", ["hour", "day", "month"])
def test_events_meet_the_version_of_their_time(spark, period):
    events = spark.createDataFrame(EVENTS, "n int, k string, event_timestamp timestamp")
    versions = spark.createDataFrame(VERSIONS, "k string, valid_from timestamp, valid_to timestamp, label string")
    joined = as_of_join(events, versions, ["k"], period=period)
    assert joined.columns == ["n", "k", "event_timestamp", "valid_from", "valid_to", "label"]
    assert rows_of(joined, "n", "label") == sorted(((n, WANTED[n]) for n, _, _ in EVENTS), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_a_hot_key_is_cut_into_periods(spark):
    events = spark.range(20_000).select(
        "id", F.lit("hot").alias("k"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("event_timestamp")
    )
    versions = spark.createDataFrame([("hot", at(1), "x"), ("hot", at(8, 12), "y")], "k string, valid_from timestamp, label string")
    joined = as_of_join(events, versions, ["k"], valid_to=None)
    assert rows_of(joined.groupBy("label").count()) == [("x", 10_800), ("y", 9_200)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan
    assert "_period" in plan.split("Window [")[1]


def test_no_versions_and_no_events(spark):
    events = spark.createDataFrame(EVENTS, "n int, k string, event_timestamp timestamp")
    versions = spark.createDataFrame(VERSIONS, "k string, valid_from timestamp, valid_to timestamp, label string")
    assert as_of_join(events, versions.where("false"), ["k"]).where("label IS NULL").count() == len(EVENTS)
    assert as_of_join(events.where("false"), versions, ["k"]).count() == 0


def test_compaction_keeps_rows_and_leaves_busy_partitions(spark, tmp_path):
    path = str(tmp_path / "lake")
    events = normalize_timestamps(testdata.viewing_events(spark, SMALL)).where("event_date < '2024-01-06'")
    events.repartition(5, "event_id").write.partitionBy("event_date", "region").parquet(path)
    before = rows_of(fingerprint(spark.read.parquet(path), ["event_date", "region"]))
    busy = date(2024, 1, 3)
    done = compact(spark, path, ["content_id"], busy=[busy])
    assert done and busy not in {day for day, _ in done}
    files = {(r.event_date, r.region): r.files for r in partition_report(spark, path).collect()}
    assert all(n == 1 for (day, _), n in files.items() if day != busy)
    assert all(n > 1 for (day, region), n in files.items() if day == busy and region == "UK")
    assert rows_of(fingerprint(spark.read.parquet(path), ["event_date", "region"])) == before
    assert compact(spark, path, ["content_id"], busy=[busy]) == []
    one = next((tmp_path / "lake" / "event_date=2024-01-02" / "region=UK").glob("part-*"))
    contents = [r.content_id for r in spark.read.parquet(str(one)).select("content_id").collect()]
    assert contents == sorted(contents)


NAMES = VIEWING_EVENTS.fieldNames()
GOOD = dict(zip(NAMES, ["E1", "C1", "M1", "2024-01-01T10:00:00Z", "UK", "web", "play", "60.0", "0.5", "free"]))


def land(tmp_path, day, names, **changed):
    folder = tmp_path / "raw" / "viewing_events" / f"ingest_date=2024-01-0{day}"
    folder.mkdir(parents=True)
    row = {**GOOD, "event_id": f"E{day}", **changed}
    (folder / "part.csv").write_text(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")


def test_columns_are_read_by_name(spark, tmp_path):
    zones = Zones(str(tmp_path))
    land(tmp_path, 1, NAMES)
    land(tmp_path, 2, NAMES[::-1])
    land(tmp_path, 3, [*NAMES[:4], "mood", *NAMES[4:]], mood="glad")
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    rows = read_landed_events(spark, zones.raw_events, days, zones.event_columns)
    assert rows_of(rows, "event_id", "content_id", "watch_minutes", "region", "ingest_date") == [
        (f"E{d.day}", "M1", 60.0, "UK", d) for d in days
    ]
    assert known_columns(spark, zones.event_columns) == [*NAMES, "mood"]
    assert {r["_corrupt_record"] for r in rows.collect()} == {None}


def test_a_renamed_column_stops_the_run_before_it_writes(spark, tmp_path):
    zones = Zones(str(tmp_path))
    names = ["minutes" if n == "watch_minutes" else n for n in NAMES]
    land(tmp_path, 1, names, minutes="3")
    with pytest.raises(ValueError, match=r"missing \['watch_minutes'\].*added \['minutes'\]"):
        daily_run.run_incremental(spark, zones, "one", datetime(2024, 2, 1))
    assert not (tmp_path / "checked").exists()
    assert daily_run.pending_dates(spark, zones) == [date(2024, 1, 1)]


def test_a_date_without_files_is_empty(spark, tmp_path):
    (tmp_path / "raw" / "ingest_date=2024-01-01").mkdir(parents=True)
    assert read_landed_events(spark, str(tmp_path / "raw"), [date(2024, 1, 1)]).count() == 0
    assert read_landed_events(spark, str(tmp_path / "raw"), []).count() == 0


def test_batches_are_in_the_run_log(spark, make_events, tmp_path):
    source = str(tmp_path / "events")
    for n in range(3):
        made = make_events(*({"event_id": f"{n}-{i}"} for i in range(4 + n)))
        made.coalesce(1).write.mode("append").parquet(source)
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        count_into(open_files(spark, source, made.schema, max_files=1), str(tmp_path / "c"), str(tmp_path / "s"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    log.write(spark, str(tmp_path / "runs"), "stream", datetime(2024, 2, 1))
    rows = spark.read.parquet(str(tmp_path / "runs"))
    assert rows.agg(F.sum("input_rows")).first()[0] == 15
    assert rows.count() == 3 and rows.where("status = 'success'").count() == 3
