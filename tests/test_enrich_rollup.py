from datetime import date, datetime

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from viewlake.functions import derive_fields, normalize_timestamps
from viewlake.operators import enrich, marts, quality, rollup
from viewlake.sources import testdata


@pytest.fixture
def metadata(spark):
    return spark.createDataFrame(
        [("M1", "One", "drama", "S", "2020-01-01", "movie"),
         ("M2", "Two", "crime", "S", "2021-01-01", "series")],
        "content_id string, title string, genre string, studio string,"
        " release_date string, content_type string",
    )


@pytest.fixture
def launch(spark):
    return spark.createDataFrame(
        [("M1", "UK", "2024-01-01", "2024-01-03", "delayed"),
         ("M1", "US", "2024-01-01", "2024-01-01", "on_time"),
         ("M2", "UK", "2024-01-01", None, "cancelled")],
        "content_id string, region string, planned_launch_date string,"
        " actual_launch_date string, launch_status string",
    )


def test_joins_keep_every_event(make_events, metadata, launch):
    rows = make_events({"content_id": "M1"}, {"content_id": "M9"}, {"content_id": None})
    joined = enrich.enrich_with_launch(enrich.enrich_with_metadata(rows, metadata), launch)
    assert rows_of(joined, "content_id", "title", "launch_status") == [
        ("M1", "One", "delayed"), ("M9", None, None), (None, None, None),
    ]


@pytest.mark.parametrize("strategy", ["merge", "shuffle_hash"])
def test_strategies_agree(spark, strategy):
    events = testdata.viewing_events(spark, SMALL)
    metadata = testdata.content_metadata(spark, SMALL)
    auto = enrich.enrich_with_metadata(events, metadata)
    other = enrich.enrich_with_metadata(events, metadata, strategy)
    assert auto.exceptAll(other).count() == 0
    assert auto.count() == other.count() == 1000


def test_unknown_strategy_is_refused(make_events, metadata):
    with pytest.raises(ValueError):
        enrich.enrich_with_metadata(make_events({}), metadata, "broadcast")


def test_unmatched_content(make_events, metadata):
    rows = make_events(
        {"content_id": "M1"}, {"content_id": "M9"}, {"content_id": "M9"},
        {"content_id": None},
    )
    assert rows_of(enrich.unmatched_content(rows, metadata)) == [("M9", 2), (None, 1)]


def test_daily_grain(make_events, launch):
    rows = make_events(
        {"watch_minutes": 30.0, "completion_rate": 0.95},
        {"watch_minutes": 31.0, "completion_rate": 0.5},
        {"watch_minutes": 2.0, "completion_rate": None},
        {"device_type": "tv", "completion_rate": None},
    )
    derived = derive_fields(
        enrich.enrich_with_launch(normalize_timestamps(rows), launch)
    )
    assert rows_of(rollup.aggregate_daily(derived).drop("event_date")) == [
        ("M1", "UK", "tv", 1, 60.0, 1.0, 0, None),
        ("M1", "UK", "web", 3, 63.0, 1.05, 1, 0.725),
    ]


def test_daily_views_add_up(spark):
    events = normalize_timestamps(testdata.viewing_events(spark, SMALL))
    daily = rollup.aggregate_daily(events.withColumn("is_completed", F.lit(False)))
    assert daily.agg(F.sum("views")).first()[0] == 1000


def test_salted_sums_equal_plain_sums(make_events):
    rows = make_events(
        *({"event_id": f"e{i}", "content_id": "hot" if i % 3 else f"c{i}",
           "watch_minutes": i / 100} for i in range(60))
    )
    plain = rows.groupBy("content_id").agg(
        F.count("*").alias("rows"),
        F.sum(F.col("watch_minutes").cast("decimal(24,6)")).cast("double"),
    )
    for salts in (1, 8):
        salted = rollup.salted_sums(
            rows, ["content_id"], {"m": F.col("watch_minutes")}, "event_id", salts
        )
        assert rows_of(salted) == rows_of(plain)


def test_filter_window(make_events):
    rows = normalize_timestamps(
        make_events(
            {"event_id": "a", "region": "UK"},
            {"event_id": "b", "region": "US"},
            {"event_id": "c", "event_timestamp": datetime(2024, 1, 9)},
        )
    )
    first = (date(2024, 1, 1), date(2024, 1, 1))
    assert rows_of(marts.filter_window(rows, ["UK"], *first), "event_id") == [("a",)]
    assert marts.filter_window(rows, None, *first).count() == 2
    assert marts.filter_window(rows, [], *first).count() == 0


def test_resolve_range():
    today = date(2024, 3, 20)
    default = (date(2024, 3, 6), today)
    assert marts.resolve_range(None, None, today) == default
    assert marts.resolve_range(date(2024, 1, 1), None, today) == default
    both = (date(2024, 1, 1), date(2024, 1, 2))
    assert marts.resolve_range(*both, today) == both


def test_top_k_breaks_ties_by_id(make_events):
    rows = normalize_timestamps(
        make_events(*({"event_id": c, "content_id": c} for c in "dbca"))
    ).withColumn("title", F.lit("Same"))
    assert [r.content_id for r in marts.top_content(rows, 2).collect()] == ["a", "b"]
    titles = marts.top_titles(rows.withColumn("title", F.lit(None).cast("string")), 3)
    assert [r.title for r in titles.collect()] == ["a", "b", "c"]


def test_contents_with_one_title_stay_apart(make_events):
    rows = normalize_timestamps(
        make_events({"content_id": "a"}, {"content_id": "b"}, {"content_id": "b"})
    ).withColumn("title", F.lit("Same"))
    assert [tuple(r) for r in marts.top_titles(rows).collect()] == [
        ("Same", 2.0, 2), ("Same", 1.0, 1),
    ]


def test_kpis_of_nothing(make_events):
    rows = normalize_timestamps(make_events({})).where("false")
    assert rows_of(marts.kpis(rows)) == [(0, None, None, 0)]


def test_launch_success(launch):
    assert rows_of(marts.launch_success(launch)) == [
        ("UK", 2, 0, 1, 1, 0.0), ("US", 1, 1, 0, 0, 100.0),
    ]
    assert rows_of(marts.launch_success(launch, ["US"]), "region") == [("US",)]


def test_category_mix_and_skew(make_events):
    rows = make_events(
        *({"content_id": "hot"} for _ in range(6)),
        *({"content_id": c, "region": None} for c in "aabc"),
    )
    mix = {(r.attribute, r.value): (r.rows, r.share)
           for r in quality.category_mix(rows, ["region", "device_type"]).collect()}
    assert mix == {
        ("region", "UK"): (6, 0.6),
        ("region", None): (4, 0.4),
        ("device_type", "web"): (10, 1.0),
    }
    assert rows_of(quality.skew_profile(rows, "content_id")) == [
        ("a", 2, 0.2, 2), ("b", 1, 0.1, 3), ("c", 1, 0.1, 3), ("hot", 6, 0.6, 1),
    ]


def test_label_metrics(spark):
    rows = spark.createDataFrame(
        [(True, True)] * 3 + [(True, False)] + [(False, True)] + [(False, False)] * 5,
        "flag boolean, truth boolean",
    )
    row = quality.label_metrics(rows, F.col("flag"), F.col("truth")).first()
    assert tuple(row) == (3, 1, 1, 5, 0.75, 0.75, 1 / 6)
    empty = quality.label_metrics(rows.where("false"), F.col("flag"), F.col("truth"))
    assert empty.first().precision is None


def test_counting_rides_on_another_action(make_events, tmp_path):
    rows, seen = quality.counted(make_events({}, {"region": None}), "n",
                                 nulls=F.count_if(F.col("region").isNull()))
    rows.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"rows": 2, "nulls": 1}


def test_repeats_in_metadata_multiply_no_event(spark, make_events):
    metadata = spark.createDataFrame(
        [("M1", "One", "g"), ("M1", "Two", "a"), ("M1", "Two", "a")], "content_id string, title string, genre string"
    )
    joined = enrich.enrich_with_metadata(make_events({}, {"event_id": "E2"}), metadata)
    assert rows_of(joined, "event_id", "title", "genre") == [("E1", "Two", "a"), ("E2", "Two", "a")]
    assert rows_of(enrich.repeated_reference(metadata, ["content_id"])) == [("M1", 3, 2)]


def parts_folder(spark, path, n):
    """Parts whose file is far smaller than the launches made from it."""
    parts = spark.range(0, n, 1, 1).selectExpr(
        "id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type",
        "CAST(1 AS INT) AS p_size", "1.0D AS p_retailprice",
    )
    parts.write.parquet(f"{path}/part.parquet")
    return str(path)


def test_a_large_reference_is_merged_whatever_its_estimate(spark, make_events, tmp_path):
    from test_plans import plan

    launch = testdata.content_launch(spark, parts_folder(spark, tmp_path, 40_000))
    events = make_events({"content_id": "CONT-39999"}, {"content_id": "CONT-40000"})
    joined = enrich.enrich_with_launch(events, launch)
    assert "SortMergeJoin" in plan(joined) and "BroadcastHashJoin" not in plan(joined)
    assert [r[0] is None for r in rows_of(joined, "planned_launch_date")] == [False, True]
    few = launch.limit(10_000)
    assert "BroadcastHashJoin" in plan(enrich.enrich_with_launch(events, few))


def test_rows_are_dealt_out_before_the_greatest_is_found(spark, tmp_path):
    from test_plans import plan

    launch = testdata.content_launch(spark, parts_folder(spark, tmp_path, 100))
    unique = enrich.one_row_per_key(launch, ["content_id", "region"])
    scanned = plan(unique).rsplit("Exchange", 1)[1]
    assert "FileScan" in scanned and "Aggregate" not in scanned and "Sort" not in scanned
    assert rows_of(unique) == rows_of(launch.select(unique.columns))
