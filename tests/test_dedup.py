from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewlake.operators import dedup

T0 = datetime(2024, 1, 1)


def test_latest_row_wins(make_events):
    rows = make_events(
        {"event_id": "a", "event_timestamp": T0, "content_id": "old"},
        {"event_id": "a", "event_timestamp": T0 + timedelta(minutes=1), "content_id": "new"},
        {"event_id": "b", "event_timestamp": T0, "content_id": "only"},
    )
    unique, duplicates = dedup.deduplicate(rows)
    assert rows_of(unique, "event_id", "content_id") == [("a", "new"), ("b", "only")]
    assert rows_of(duplicates, "content_id", "rejection_reason") == [
        ("old", "DUPLICATE_EVENT_ID")
    ]


def test_unique_rows_pass_through(make_events):
    rows = make_events(*({"event_id": f"e{i}"} for i in range(3)))
    unique, duplicates = dedup.deduplicate(rows)
    assert (unique.count(), duplicates.count()) == (3, 0)


def test_missing_time_loses_and_ties_break_by_the_other_columns(make_events):
    rows = make_events(
        {"event_id": "a", "event_timestamp": None, "content_id": "z"},
        {"event_id": "a", "event_timestamp": T0, "content_id": "x"},
        {"event_id": "a", "event_timestamp": T0, "content_id": "y"},
    )
    for parts in (1, 3):
        unique, duplicates = dedup.deduplicate(rows.repartition(parts))
        assert rows_of(unique, "content_id") == [("y",)]
        assert rows_of(duplicates, "content_id") == [("x",), ("z",)]


def test_rows_without_key_are_one_group(make_events):
    rows = make_events(*({"event_id": None, "content_id": str(i)} for i in range(4)))
    unique, duplicates = dedup.deduplicate(rows)
    assert rows_of(unique, "content_id") == [("3",)]
    assert duplicates.count() == 3


def test_many_exact_copies_are_written_out_in_portions(make_events, monkeypatch):
    monkeypatch.setattr(dedup, "COPIES_PER_PORTION", 7)
    rows = make_events({"event_id": "hot"}, {"event_id": "cold"})
    hot = rows.where("event_id = 'hot'")
    copies = hot.crossJoin(rows.sparkSession.range(100).select()).unionByName(
        rows.where("event_id = 'cold'")
    )
    unique, duplicates = dedup.deduplicate(copies)
    assert unique.count() == 2
    assert duplicates.count() == 99
    assert duplicates.distinct().count() == 1


def test_a_hot_key_is_spread_over_tasks(spark):
    rows = spark.range(8000).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id AS t", "id AS v"
    )
    lost = dedup.superseded(rows, ["k"], "t")
    per_task = lost.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 2666
    assert len(per_task) == 4
    assert max(r["count"] for r in per_task) < 1000


def _expected(rows):
    kept, lost = [], []
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: r[1:])
        kept.append(group[-1])
        lost += group[:-1]
    return Counter(kept), Counter(lost)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 2)),
        min_size=1,
        max_size=25,
    )
)
def test_against_brute_force(spark, rows):
    frame = spark.createDataFrame(rows, "k string, t int, v int").repartition(3)
    kept, lost = _expected(rows)
    unique = dedup.keep_latest(frame, ["k"], "t")
    others = dedup.superseded(frame, ["k"], "t").drop("rejection_reason")
    assert Counter(tuple(r) for r in unique.collect()) == kept
    assert Counter(tuple(r) for r in others.collect()) == lost


@pytest.mark.parametrize("keys", [["event_id"], ["event_id", "region"]])
def test_deduplicating_again_changes_nothing(make_events, keys):
    rows = make_events(
        {"event_id": "a"}, {"event_id": "a", "region": "US"}, {"event_id": "a"}
    )
    once = dedup.keep_latest(rows, keys)
    assert rows_of(dedup.keep_latest(once, keys)) == rows_of(once)
    assert dedup.superseded(once, keys).count() == 0
