"""The plans that make the operators scale."""

from datetime import date, datetime

import pytest
from conftest import SMALL

from catalog.queries import QUERIES
from viewlake.functions import normalize_timestamps
from viewlake.operators import dedup, enrich, keys, marts, quality
from viewlake.plans import warehouse
from viewlake.sinks import write_partitioned
from viewlake.sources import read_lake, testdata

WEEK = (date(2024, 1, 1), date(2024, 1, 7))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return normalize_timestamps(testdata.viewing_events(spark, SMALL))


@pytest.fixture(scope="module")
def lake(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "events")
    write_partitioned(events, path)
    return read_lake(spark, path)


def test_window_filter_prunes_partitions_and_columns(lake):
    text = plan(marts.watch_hours_by_content(marts.filter_window(lake, ["UK"], *WEEK)))
    pruning = next(x for x in text.split("PartitionFilters")[1:])
    assert "event_date" in pruning.split("]")[0]
    assert "region" in pruning
    assert "ReadSchema: struct<content_id:string,watch_minutes:double>" in text
    assert "TakeOrderedAndProject" in text


def test_survivors_are_limited_before_the_shuffle(events):
    text = plan(dedup.keep_latest(events))
    before_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle
    assert text.count("Exchange hashpartitioning") == 1


def test_first_count_of_superseded_reads_the_key_only(spark):
    rows = testdata.read_table(spark, SMALL, "events")
    text = plan(dedup.superseded(rows, ["event_id"], "ts"))
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_small_reference_is_broadcast_by_size(spark, events):
    metadata = testdata.content_metadata(spark, SMALL)
    joined = enrich.enrich_with_metadata(events, metadata)
    assert "BroadcastHashJoin" in plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        joined = enrich.enrich_with_metadata(events, metadata)
        assert "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counts_combine_before_the_shuffle(events):
    for frame in (marts.daily_trend(events), marts.region_breakdown(events)):
        assert "partial_count" in plan(frame)


def test_fact_sums_before_looking_up_keys(spark, events):
    metadata = testdata.content_metadata(spark, SMALL)
    dims = warehouse.load_dimensions(spark, events, metadata, datetime(2024, 1, 1))
    fact = warehouse.fact_viewing(events, dims)
    optimized = fact._jdf.queryExecution().optimizedPlan().toString()
    # Below every key lookup of the events there is a sum by natural key.
    lookups, natural = optimized.index("Join"), optimized.index(
        "Aggregate [content_id"
    )
    assert lookups < natural
    assert "sum(_minutes" in optimized[:lookups]


@pytest.mark.parametrize("name", sorted(
    n for n in QUERIES
    if not n.startswith("stream") and n not in
    ("incremental_daily", "written_partitions", "csv_vs_parquet")
))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for operator in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text


def test_single_task_windows_see_bounded_rows_only(events):
    """Windows without a partition run on bucket totals or the size histogram."""
    text = plan(quality.skew_profile(events, "customer_id"))
    single = text[text.index("Exchange SinglePartition"):]
    assert "HashAggregate(keys=[rows" in single.split("FileScan")[0]
    none = events.sparkSession.createDataFrame([], "content_id string, k int")
    text = plan(keys.stable_keys(none, events, ["content_id"], "k"))
    for single in text.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[_bucket" in single.split("Exchange")[0]
