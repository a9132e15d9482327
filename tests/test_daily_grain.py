"""Questions answered from the daily aggregate and from bitmaps."""

from datetime import date, datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from viewlake.functions import is_completed, normalize_timestamps
from viewlake.operators import bitmaps, keys, marts, rollup


@pytest.fixture
def grains(make_events):
    rows = [
        {
            "event_id": f"E{i}",
            "content_id": f"M{i % 7}" if i % 11 else None,
            "region": ("UK", "US", "DE")[i % 3],
            "device_type": ("web", "tv")[i % 2],
            "event_timestamp": datetime(2024, 1, 1) + timedelta(hours=5 * i),
            "watch_minutes": None if i % 13 == 0 else i * 1.37 + 1 / 3,
            "completion_rate": None if i % 5 == 0 else (i % 100) / 100,
        }
        for i in range(120)
    ]
    events = normalize_timestamps(make_events(*rows)).withColumn("is_completed", is_completed())
    return events, rollup.aggregate_daily(events, partials=True)


QUESTIONS = {
    "kpis": marts.kpis,
    "daily_trend": marts.daily_trend,
    "completion_by_device": marts.completion_by_device,
    "region_breakdown": marts.region_breakdown,
    "trend_by_date": marts.trend_by_date,
    "weekly_trend": marts.weekly_trend,
    "device_completion_chart": marts.device_completion_chart,
    "watch_hours_by_content": marts.watch_hours_by_content,
}


@pytest.mark.parametrize("name", QUESTIONS)
def test_both_grains_give_the_same_answer(grains, name):
    events, daily = grains
    for regions in (None, ["UK", "DE"], []):
        window = (regions, date(2024, 1, 3), date(2024, 1, 20))
        answers = [QUESTIONS[name](marts.filter_window(g, *window)) for g in (events, daily)]
        assert answers[0].dtypes == answers[1].dtypes
        assert [tuple(r) for r in answers[0].collect()] == [tuple(r) for r in answers[1].collect()]


def test_the_chooser_takes_the_coarsest_that_covers(grains):
    events, daily = grains
    assert marts.coarsest(["region", "event_date"], daily, events) is daily
    assert marts.coarsest(["region", "customer_id"], daily, events) is events
    with pytest.raises(ValueError):
        marts.coarsest(["mood"], daily, events)


def test_answers_read_only_the_daily_table(spark, grains, tmp_path):
    events, daily = grains
    daily.write.partitionBy("event_date").parquet(str(tmp_path / "daily"))
    rows = marts.filter_window(spark.read.parquet(str(tmp_path / "daily")), None, date(2024, 1, 3), date(2024, 1, 4))
    answer = marts.region_breakdown(rows)
    assert all("/daily/" in f for f in answer.inputFiles())
    scan = answer._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "avg_completion_rate" not in scan.split("ReadSchema:")[1].split("\n")[0]


def test_bitmaps_count_exactly_over_any_range(spark, grains):
    events, daily = grains
    many = spark.range(100_000).select(
        F.concat(F.lit("C"), F.col("id") % 70_000).alias("content_id"),
        F.lit("JP").alias("region"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 5).cast("int")).alias("event_date"),
    )
    rows = daily.select("content_id", "region", "event_date").unionByName(many)
    numbers = keys.stable_keys(None, rows, ["content_id"], "number")
    made = bitmaps.member_bitmaps(rows, numbers, "content_id", "number", ["event_date", "region"]).cache()
    assert made.select("bucket").distinct().count() == 3  # of 32,768 members each
    for first, last in ((1, 1), (2, 4), (1, 31)):
        window = F.col("event_date").between(date(2024, 1, first), date(2024, 1, last))
        want = rows.where(window).groupBy("region").agg(F.count_distinct("content_id"))
        assert rows_of(bitmaps.distinct_members(made.where(window), ["region"])) == rows_of(want)
    everywhere = bitmaps.distinct_members(made, [])
    assert everywhere.first()[0] == rows.select("content_id").dropna().distinct().count()
