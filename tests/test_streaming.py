import pytest
from catalog.queries import QUERIES
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from datetime import datetime

from viewlake.plans.transform import check_events
from viewlake.operators.quality import anomaly_flags
from viewlake.sources import land_raw, testdata
from viewlake.streaming import (
    check_arrivals,
    count_into,
    dedup_available,
    dedup_stream,
    hourly_counts,
    open_files,
    open_raw_events,
    run_available,
)


def test_stream_takes_each_file_once_and_equals_the_batch(spark, tmp_path):
    raw = testdata.raw_events(spark, SMALL)
    base, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    half = F.lit(datetime(2024, 1, 15).date())

    def take():
        arrivals = check_arrivals(open_raw_events(spark, base, max_files=20))
        return run_available(arrivals, out, state, ("status", "ingest_date"))

    land_raw(raw.where(F.col("ingest_date") <= half), base)
    first = take().count()
    assert 0 < first < 1009
    assert take().count() == first
    land_raw(raw.where(F.col("ingest_date") > half), base)
    taken = take()
    columns = ["event_id", "event_timestamp", "region", "rejection_reason"]
    expected = check_events(raw).select(columns)
    assert taken.select(columns).exceptAll(expected).count() == 0
    assert taken.count() == expected.count() == 1009


def test_stream_keeps_one_copy_and_closed_hours(spark, tmp_path, make_events):
    rows = make_events(
        {"event_id": "a", "event_timestamp": datetime(2024, 1, 1, 10, 5)},
        {"event_id": "a", "event_timestamp": datetime(2024, 1, 1, 10, 6)},
        {"event_id": "b", "event_timestamp": datetime(2024, 1, 1, 10, 7)},
        {"event_id": "c", "event_timestamp": datetime(2024, 1, 1, 15, 0)},
    )
    source = str(tmp_path / "events")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    unique = run_available(
        dedup_stream(stream, "1 day"), str(tmp_path / "u"), str(tmp_path / "us")
    )
    assert rows_of(unique, "event_id") == [("a",), ("b",), ("c",)]
    hours = run_available(
        hourly_counts(stream, delay="1 hour"), str(tmp_path / "h"), str(tmp_path / "hs")
    )
    assert rows_of(hours, "window_start", "events") == [(datetime(2024, 1, 1, 10), 3)]
    assert rows_of(hourly_counts(rows), "window_start", "events") == [
        (datetime(2024, 1, 1, 10), 3), (datetime(2024, 1, 1, 15), 1),
    ]


def test_streamed_hours_equal_the_batch(spark):
    got, batch = (QUERIES[n](spark, SMALL) for n in ("stream_hourly_counts", "hourly_counts"))
    assert got.columns == batch.columns and got.count() == batch.count()
    assert got.exceptAll(batch).count() == batch.exceptAll(got).count() == 0


def test_streamed_hours_take_in_late_rows(spark, tmp_path, make_events):
    source, state = str(tmp_path / "events"), str(tmp_path / "state")
    times = [datetime(2024, 1, 1, 15, 0), datetime(2024, 1, 1, 10, 5), datetime(2024, 1, 1, 15, 9)]
    for at, time in enumerate(times):
        rows = make_events({"event_timestamp": time, "event_type": None})
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        counted = count_into(stream, str(tmp_path / "counts"), state)
        batch = hourly_counts(spark.read.parquet(source))
        assert sorted(map(str, counted.collect())) == sorted(map(str, batch.collect()))


def test_anomaly_rules(make_events):
    rows = make_events(
        {"event_id": "ok"},
        {"event_id": "long", "watch_minutes": 301.0},
        {"event_id": "fast", "event_type": "complete", "watch_minutes": 0.5},
        {"event_id": "skip", "event_type": "skip", "completion_rate": 0.91},
        {"event_id": "null", "watch_minutes": None, "event_type": None},
    )
    flags = anomaly_flags(rows)
    assert rows_of(flags.where("is_anomaly"), "event_id", "flags") == [
        ("fast", 1), ("long", 1), ("skip", 1),
    ]
    assert flags.where("is_anomaly IS NULL").count() == 0


def write_batches(spark, make_events, source, *hours):
    """A file for each batch, in order."""
    for n, batch in enumerate(hours):
        rows = make_events(*({"event_id": f"{n}-{i}", "event_timestamp": datetime(2024, 1, d, h)} for i, (d, h) in enumerate(batch)))
        rows.coalesce(1).write.mode("append").parquet(source)
    return rows.schema


def as_text(frame):
    return sorted(map(str, frame.collect()))


def test_repeated_batches_and_restarts_count_once(spark, make_events, tmp_path, monkeypatch):
    from viewlake.streaming import live

    source, table, state = (str(tmp_path / n) for n in ("events", "counts", "state"))
    schema = write_batches(spark, make_events, source, [(1, 10), (1, 11)], [(1, 10), (2, 5)], [(1, 23), (1, 10)])

    def take(**how):
        return count_into(open_files(spark, source, schema, **how), table, state)

    # The second batch is written but its pointer is not; then the process ends.
    real, calls = live.publish, []

    def fail_once(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("gone")
        return real(*args)

    with monkeypatch.context() as broken:
        broken.setattr(live, "publish", fail_once)
        with pytest.raises(Exception):
            take(max_files=1)
    counted = take(max_files=1)
    batch = hourly_counts(spark.read.parquet(source))
    assert as_text(counted) == as_text(batch)
    # Spark forgets that the last batch was done and repeats it.
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for path in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        path.unlink(missing_ok=True)
    assert as_text(take()) == as_text(batch)
    assert not (tmp_path / "state" / "state").exists()  # nothing is kept between batches
    # Rows long behind the others are counted as well.
    write_batches(spark, make_events, source, [(1, 10)])
    assert as_text(take()) == as_text(hourly_counts(spark.read.parquet(source)))
    with pytest.raises(ValueError, match="another checkpoint"):
        count_into(open_files(spark, source, schema), table, str(tmp_path / "fresh"))


def test_every_row_is_kept_a_copy_or_late(spark, make_events, tmp_path):
    source, base = str(tmp_path / "events"), str(tmp_path / "out")

    def take(*rows):
        made = make_events(*({"event_id": e, "event_timestamp": datetime(2024, 1, d, h)} for e, d, h in rows))
        made.coalesce(1).write.mode("append").parquet(source)
        return dedup_available(open_files(spark, source, made.schema), base, 86_400)

    take(("a", 1, 1), ("a", 1, 2), ("b", 5, 0))
    take(("a", 1, 3), ("b", 5, 1), ("c", 4, 1), ("d", 9, 0))
    done = take(("e", 7, 23), ("f", 8, 1), ("f", 8, 2), ("c", 4, 1))
    assert rows_of(done.late, "event_id") == [("a",), ("c",), ("e",)]
    assert rows_of(done.unique, "event_id") == [("a",), ("b",), ("c",), ("d",), ("f",)]
    assert rows_of(done.duplicates, "event_id") == [("a",), ("b",), ("f",)]
    total = sum(rows.count() for rows in (done.unique, done.duplicates, done.late))
    assert total == spark.read.parquet(source).count() == 11
    assert done.unique.columns == done.duplicates.columns == done.late.columns
    assert list((tmp_path / "out" / "state-unique" / "state").rglob("*.changelog"))
