"""The launch join over tables in the same buckets."""

from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from viewlake.operators.enrich import enrich_with_launch
from viewlake.plans.colocated import (
    Colocated,
    drop_colocated,
    join_colocated,
    write_colocated,
)
from viewlake.sources import testdata

NAMES = Colocated("bucketed_events", "bucketed_launches")


def test_events_are_not_shuffled(spark, tmp_path):
    hot = F.when(F.col("event_id") > "EVT-000000300", F.lit("CONT-00001")).otherwise(F.col("content_id"))
    events = testdata.viewing_events(spark, SMALL).withColumn("content_id", hot)
    events = events.withColumn("content_id", F.when(F.col("event_id") != "EVT-000000007", F.col("content_id")))
    launches = testdata.content_launch(spark, SMALL)
    for salts in (1, 4):
        write_colocated(events, launches, NAMES, str(tmp_path / f"t{salts}"), buckets=5, salts=salts)
        joined = join_colocated(spark, NAMES)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = enrich_with_launch(events, launches).select(joined.columns)
        assert rows_of(joined) == rows_of(want)
        hottest = spark.table(NAMES.events).where("content_id = 'CONT-00001'")
        files = hottest.groupBy("region").agg(F.count_distinct("_metadata.file_path").alias("n"))
        assert (files.agg(F.max("n")).first()[0] > 1) == (salts > 1)
        drop_colocated(spark, NAMES)
    assert not spark.catalog.tableExists(NAMES.events)


def test_repeated_launches_multiply_no_event(spark, make_events, tmp_path):
    columns = "content_id string, region string, planned_launch_date string, actual_launch_date string, launch_status string"
    launches = spark.createDataFrame([("M1", "UK", "2024-01-01", None, "on_time"), ("M1", "UK", "2024-01-02", None, "on_time")], columns)
    write_colocated(make_events({}, {"content_id": None}), launches, NAMES, str(tmp_path), buckets=2, salts=3)
    assert rows_of(join_colocated(spark, NAMES), "content_id", "planned_launch_date") == [("M1", "2024-01-02"), (None, None)]
    drop_colocated(spark, NAMES)
