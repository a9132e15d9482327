from datetime import date, datetime

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from viewlake.functions import normalize_timestamps
from viewlake.operators import fingerprint as prints
from viewlake.plans import formats
from viewlake.plans.transform import check_events
from viewlake.plans.zones import replace_partitions
from viewlake import sinks, sources
from viewlake.sources import testdata

HEADER = (
    "event_id,customer_id,content_id,event_timestamp,region,device_type,event_type,"
    "watch_minutes,completion_rate,subscription_type\n"
)


def land_text(tmp_path, day, *lines):
    folder = tmp_path / "raw" / f"ingest_date={day}"
    folder.mkdir(parents=True)
    (folder / "events.csv").write_text(HEADER + "".join(f"{x}\n" for x in lines))
    return str(tmp_path / "raw")


def test_timestamps_with_and_without_fraction(spark, tmp_path):
    tail = "UK,web,play,1.5,0.5,free"
    base = land_text(
        tmp_path, "2024-01-02",
        f"a,c,m,2024-01-01T10:00:00+00:00,{tail}",
        f"b,c,m,2024-01-01T10:00:00.250000+00:00,{tail}",
        f"c,c,m,2024-01-01T12:00:00.25+02:00,{tail}",
        f"d,c,m,2024-01-01T12:00:00.125+02:00,{tail}",
        f"e,c,m,not-a-time,{tail}",
    )
    found = dict(rows_of(sources.read_viewing_events(spark, base),
                         "event_id", "event_timestamp"))
    assert found["a"] == datetime(2024, 1, 1, 10)
    assert found["b"] == datetime(2024, 1, 1, 10, 0, 0, 250000)
    assert found["d"] == datetime(2024, 1, 1, 10, 0, 0, 125000)
    assert found["e"] is None


def test_broken_rows_are_kept_with_their_text(spark, tmp_path):
    base = land_text(
        tmp_path, "2024-01-02",
        "a,c,m,2024-01-01T10:00:00+00:00,UK,web,play,many,0.5,free",
        "b,c",
    )
    checked = check_events(sources.read_viewing_events(spark, base))
    found = {r.event_id: r for r in checked.collect()}
    assert found["a"].rejection_reason == "NULL_WATCH_MINUTES"
    assert "many" in found["a"]._corrupt_record
    assert found["b"].rejection_reason == "INVALID_TIMESTAMP"
    assert found["b"]._corrupt_record == "b,c"
    assert found["b"].ingest_date == date(2024, 1, 2)


def test_landed_rows_come_back_equal(spark, tmp_path):
    raw = testdata.raw_events(spark, SMALL)
    base = str(tmp_path / "raw")
    days = sources.land_raw(raw, base)
    assert len(days) == 30
    back = sources.read_viewing_events(spark, base).drop("_corrupt_record")
    same = prints.compare_fingerprints(
        prints.fingerprint(raw, ["ingest_date"]),
        prints.fingerprint(back, ["ingest_date"]),
        ["ingest_date"],
    )
    assert prints.changed_partitions(same).count() == 0
    one = sources.read_viewing_events(spark, base, days[:1])
    assert rows_of(one.select("ingest_date").distinct()) == [(days[0],)]


def test_raw_is_immutable(spark, tmp_path, make_events):
    base = str(tmp_path / "raw")
    sources.land_raw(make_events({}), base)
    with pytest.raises(FileExistsError, match="2024-01-01"):
        sources.land_raw(
            make_events({}, {"event_timestamp": datetime(2024, 1, 2)}), base
        )
    assert sources.read_viewing_events(spark, base).count() == 1


def test_partition_dates_skip_other_folders(spark, tmp_path):
    assert sources.partition_dates(spark, str(tmp_path / "none"), "ingest_date") == []
    for name in ("ingest_date=2024-08-12", "ingest_date=oops", "other"):
        (tmp_path / name).mkdir()
    assert sources.partition_dates(spark, str(tmp_path), "ingest_date") == [
        date(2024, 8, 12)
    ]


def test_overwrite_leaves_other_partitions(spark, tmp_path, make_events):
    path = str(tmp_path / "lake")
    two_days = normalize_timestamps(
        make_events({"event_id": "a"},
                    {"event_id": "b", "event_timestamp": datetime(2024, 1, 2)})
    )
    sinks.write_partitioned(two_days, path)
    sinks.write_partitioned(
        normalize_timestamps(make_events({"event_id": "A"}, {"event_id": "C"})), path
    )
    assert rows_of(sources.read_lake(spark, path), "event_id") == [("A",), ("C",), ("b",)]
    assert sources.partition_paths(spark, path, "event_date", "region") == [
        ("2024-01-01", "UK"), ("2024-01-02", "UK"),
    ]
    one = sources.read_partition(spark, path, event_date=date(2024, 1, 2))
    assert rows_of(one, "event_id") == [("b",)]


def test_replace_removes_emptied_partitions(spark, tmp_path, make_events):
    path = str(tmp_path / "lake")
    rows = normalize_timestamps(
        make_events({"event_id": "a"}, {"event_id": "b", "region": "US"},
                    {"event_id": "c", "event_timestamp": datetime(2024, 1, 2)})
    )
    keys = ("event_date", "region")
    replace_partitions(rows, path, keys, {"2024-01-01", "2024-01-02"})
    replace_partitions(rows.where("event_id = 'a'"), path, keys, {"2024-01-01"})
    assert rows_of(sources.read_lake(spark, path), "event_id") == [("a",), ("c",)]


def test_missing_partitioned_data_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        sources.read_partition(spark, str(tmp_path / "none"), event_date="2024-01-01")


def test_dead_letter_and_report(spark, tmp_path, make_events):
    path = str(tmp_path / "dead")
    rejected = make_events({}, {}, {"event_timestamp": datetime(2024, 1, 2)}).withColumn(
        "rejection_reason", F.lit("X")
    )
    sinks.write_dead_letter(rejected, path)
    sinks.write_dead_letter(rejected, path)
    report = sinks.partition_report(spark, path, ["ingest_date"])
    assert rows_of(report, "ingest_date", "rows", "files") == [
        (date(2024, 1, 1), 2, 1), (date(2024, 1, 2), 1, 1),
    ]
    assert all(r.bytes > 0 for r in report.collect())


def test_files_are_split_by_rows(spark, tmp_path, make_events):
    path = str(tmp_path / "lake")
    rows = normalize_timestamps(make_events(*({"event_id": str(i)} for i in range(10))))
    sinks.write_partitioned(rows, path, max_rows_per_file=4)
    assert sinks.partition_report(spark, path).first().files == 3


def test_both_forms_answer_alike_and_parquet_opens_fewer_files(spark, tmp_path):
    events = normalize_timestamps(testdata.viewing_events(spark, SMALL))
    forms = formats.read_forms(
        spark, formats.write_both_forms(events, str(tmp_path))
    )
    question = ("UK", date(2024, 1, 1), date(2024, 1, 7))
    query = formats.watch_hours_query(*question)
    assert rows_of(query(forms["csv"])) == rows_of(query(forms["parquet"]))
    assert set(formats.time_forms(forms, query)) == {"csv", "parquet"}
    report = sinks.partition_report(spark, str(tmp_path / "parquet"))
    opened = formats.files_read(forms, *question)
    assert opened["parquet"] == 7 < report.agg(F.sum("files")).first()[0]


def test_baseline_parquet(spark, tmp_path, make_events):
    path = sinks.write_parquet_baseline(make_events({}, {}), str(tmp_path / "p"))
    assert spark.read.parquet(path).count() == 2


def test_sql_over_frames_and_views(spark, tmp_path, make_events):
    events = normalize_timestamps(make_events({}, {"region": "US"}))
    path = sinks.write_partitioned(events, str(tmp_path / "lake"))
    sources.open_view(spark, "lake_events", path)
    by_view = sources.run_sql(
        spark, "SELECT region, count(*) FROM lake_events GROUP BY region"
    )
    by_frame = sources.run_sql(
        spark, "SELECT region, count(*) FROM {e} GROUP BY region", e=events
    )
    assert rows_of(by_view) == rows_of(by_frame) == [("UK", 1), ("US", 1)]


def test_run_state_is_latest_by_time(spark, tmp_path):
    path = str(tmp_path / "state")

    def state(rows):
        return spark.createDataFrame(
            [(date(2024, 1, d), n, n) for d, n in rows],
            "event_date date, rows long, hash_xor long",
        )

    sinks.save_run_state(state([(1, 10), (2, 5)]), path, "z", datetime(2024, 2, 1))
    sinks.save_run_state(state([(1, 11)]), path, "a", datetime(2024, 2, 2))
    sinks.save_run_state(state([(1, 12)]), path, "a", datetime(2024, 2, 2))
    assert rows_of(sinks.latest_state(spark, path), "rows") == [(12,), (5,)]
    assert rows_of(sinks.latest_state(spark, path, without_run="a"), "rows") == [
        (10,), (5,),
    ]
    assert rows_of(sinks.run_state(spark, path, "a"), "rows") == [(12,)]
