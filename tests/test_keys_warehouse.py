from datetime import date, datetime

import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F

from viewlake import schemas
from viewlake.functions import normalize_timestamps
from viewlake.operators import keys
from viewlake.plans import warehouse
from viewlake.sources import testdata

RUN = datetime(2024, 2, 1)


def members(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_new_members_get_dense_keys(spark):
    none = spark.createDataFrame([], "name string, k int")
    names = [f"m{i}" for i in range(500)]
    keyed = keys.stable_keys(none, members(spark, *names, "m1", None), ["name"], "k")
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 501))
    assert sorted(r.name for r in keyed.collect()) == sorted(names)


def test_known_members_keep_their_key(spark):
    old = spark.createDataFrame([("b", 7), ("z", 2)], "name string, k int")
    keyed = dict(rows_of(keys.stable_keys(old, members(spark, "a", "b", "c"), ["name"], "k")))
    assert keyed["b"] == 7 and keyed["z"] == 2
    assert sorted((keyed["a"], keyed["c"])) == [8, 9]


def test_keys_do_not_depend_on_order(spark):
    none = spark.createDataFrame([], "name string, k int")
    names = members(spark, *(f"m{i}" for i in range(50)))
    one = keys.stable_keys(none, names, ["name"], "k")
    two = keys.stable_keys(none, names.orderBy(F.desc("name")).repartition(5), ["name"], "k")
    assert rows_of(one) == rows_of(two)


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    assert rows_of(keys.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    twice = keys.upsert(keys.upsert(old, new, ["k"]), new, ["k"])
    assert rows_of(twice) == rows_of(keys.upsert(old, new, ["k"]))


def test_key_checks(spark):
    fact = spark.createDataFrame([(1,), (1,), (5,), (5,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows_of(keys.repeated_keys(fact, ["k"])) == [(1, 2), (5, 2)]
    assert rows_of(keys.orphans(fact, dim, "k", "k")) == [(5, 2)]


def test_calendar_spans_eleven_years(spark):
    calendar = warehouse.dim_date(spark)
    assert calendar.count() == 4018
    assert calendar.select("date_key").distinct().count() == 4018
    assert calendar.columns == schemas.DIM_DATE.fieldNames()
    first = calendar.orderBy("date_key").first()
    assert (first.date_key, first.calendar_date) == (20200101, date(2020, 1, 1))


def test_four_regions(spark):
    regions = warehouse.dim_region(spark)
    assert [r[0] for r in rows_of(regions, "region_code")] == sorted(schemas.REGIONS)


@pytest.fixture
def dims(spark, make_events):
    metadata = spark.createDataFrame(
        [("M1", "One", "g", "s", "2020-01-01", "movie"),
         ("M2", "Two", "g", "s", "", "series"),
         ("M2", "Second", "g", "s", "", "series")],
        "content_id string, title string, genre string, studio string,"
        " release_date string, content_type string",
    )
    events = make_events({}, {"device_type": "tv"})
    return warehouse.load_dimensions(spark, events, metadata, RUN)


def test_one_dimension_row_per_content(dims):
    rows = dims["dim_content"]
    assert rows_of(rows, "content_id", "title", "release_date") == [
        ("M1", "One", date(2020, 1, 1)), ("M2", "Two", None),
    ]
    assert rows.columns == schemas.DIM_CONTENT.fieldNames()


def test_fact_measures_and_unknown_members(make_events, dims):
    events = normalize_timestamps(
        make_events(
            {"watch_minutes": 90.0, "completion_rate": 1.0},
            {"watch_minutes": None, "completion_rate": None},
            {"content_id": "M9"}, {"content_id": "M8"}, {"content_id": None},
            {"region": "XX"},
        )
    )
    kept = warehouse.fact_viewing(events, dims)
    assert kept.agg(F.sum("views")).first()[0] == 6
    assert rows_of(kept.where("content_key = 0"), "views", "watch_hours") == [(3, 3.0)]
    assert rows_of(kept.where("region_key = 0"), "views") == [(1,)]
    dropped = warehouse.fact_viewing(events, dims, "drop")
    row = dropped.first()
    assert dropped.count() == 1
    assert (row.views, row.watch_minutes, row.watch_hours) == (2, 90.0, 1.5)
    assert (row.completed_views, row.avg_completion_rate) == (1, 0.5)
    assert [f.simpleString() for f in kept.schema] == [
        f.simpleString() for f in schemas.FACT_VIEWING
    ]


def test_fact_counts_every_event(spark):
    events = normalize_timestamps(testdata.viewing_events(spark, SMALL))
    metadata = testdata.content_metadata(spark, SMALL)
    loaded = warehouse.load_dimensions(spark, events, metadata, RUN)
    fact = warehouse.fact_viewing(events, loaded)
    assert fact.agg(F.sum("views")).first()[0] == events.count()


def test_verify_finds_faults(spark, make_events, dims):
    events = normalize_timestamps(make_events({}, {"device_type": "tv"}))
    fact = warehouse.fact_viewing(events, dims)
    assert all(r.passed for r in warehouse.verify_warehouse(fact, dims).collect())
    broken = fact.unionByName(fact.limit(1)).unionByName(
        fact.limit(1).withColumns({"content_key": F.lit(99), "date_key": F.lit(1)})
    )
    failures = {r.check_name: r.failures
                for r in warehouse.verify_warehouse(broken, dims).collect()}
    assert failures == {
        "repeated_grain": 1, "orphan_content_key": 1, "orphan_region_key": 0,
        "orphan_device_key": 0, "orphan_date_key": 1,
    }
    nothing = warehouse.verify_warehouse(fact.where("false"), dims)
    assert [r.failures for r in nothing.collect()] == [0] * 5


def test_reload_changes_only_what_changed(spark, dims):
    metadata = dims["dim_content"].select(
        "content_id", "title", "genre", "studio", "release_date", "content_type"
    )
    later = datetime(2024, 3, 1)
    same = warehouse.dim_content(metadata, later, dims["dim_content"])
    assert rows_of(same) == rows_of(dims["dim_content"])
    renamed = metadata.where("content_id = 'M1'").withColumn("title", F.lit("New"))
    rows = {r.content_id: r for r in
            warehouse.dim_content(renamed, later, dims["dim_content"]).collect()}
    before = {r.content_id: r for r in dims["dim_content"].collect()}
    assert rows["M1"].title == "New" and rows["M1"].updated_at == later
    assert rows["M1"].content_key == before["M1"].content_key
    assert rows["M2"] == before["M2"]


def test_history_keeps_versions(spark):
    cols = "id string, v string"
    one = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None)], cols)
    two = spark.createDataFrame([("a", "2"), ("b", "1"), ("d", "1")], cols)
    three = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", "9"), ("d", "1")], cols)
    d1, d2, d3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
    history = warehouse.open_history(one, d1)
    history = warehouse.apply_snapshot(history, two, "id", d2)
    assert rows_of(history) == [
        ("a", "1", d1, d2, False), ("a", "2", d2, None, True),
        ("b", "1", d1, None, True), ("c", None, d1, d2, False),
        ("d", "1", d2, None, True),
    ]
    again = warehouse.apply_snapshot(history, two, "id", d3)
    assert rows_of(again) == rows_of(history)
    back = warehouse.apply_snapshot(history, three, "id", d3)
    assert rows_of(back.where("id = 'c'")) == [
        ("c", "9", d3, None, True), ("c", None, d1, d2, False),
    ]


def test_declared_tables_take_rows_and_join(spark, tmp_path, make_events, dims):
    spark.sql("CREATE DATABASE IF NOT EXISTS star")
    warehouse.create_tables(spark, str(tmp_path), "star")
    assert spark.catalog.tableExists("star.fact_content_launch")
    fact = warehouse.fact_viewing(normalize_timestamps(make_events({})), dims)
    for name, rows in {**dims, "fact_viewing": fact}.items():
        columns = spark.table(f"star.{name}").columns
        rows.select(columns).write.insertInto(f"star.{name}")
    joined = spark.sql(
        "SELECT c.title, r.region_code, d.device_type, f.views"
        " FROM star.fact_viewing f JOIN star.dim_content c USING (content_key)"
        " JOIN star.dim_region r USING (region_key)"
        " JOIN star.dim_device d USING (device_key)"
        " JOIN star.dim_date t USING (date_key)"
    )
    assert rows_of(joined) == [("One", "UK", "web", 1)]
    spark.sql("DROP DATABASE star CASCADE")


def test_large_launches_and_dimensions_are_not_broadcast(spark, tmp_path, monkeypatch):
    from test_plans import plan

    from viewlake.operators import enrich

    monkeypatch.setattr(enrich, "BROADCAST_ROWS", 20)
    contents = spark.range(1, 31).selectExpr(
        "CAST(id AS INT) AS content_key", "concat('C', id) AS content_id")
    contents.write.parquet(f"{tmp_path}/contents")
    dims = {"dim_content": spark.read.parquet(f"{tmp_path}/contents"), "dim_region": warehouse.dim_region(spark)}
    launches = spark.range(0, 40).selectExpr(
        "concat('C', id) AS content_id", "IF(id < 99, 'UK', 'US') AS region", "'2024-01-01' AS planned_launch_date",
        "CAST(NULL AS STRING) AS actual_launch_date", "'cancelled' AS launch_status")
    fact = warehouse.fact_content_launch(launches, dims)
    assert "SortMergeJoin" in plan(fact) and plan(fact).count("BroadcastHashJoin") == 1
    assert [r.content_key for r in fact.orderBy("content_key").collect()] == list(range(1, 31))
    few = {**dims, "dim_content": dims["dim_content"].where("content_key <= 5")}
    assert "SortMergeJoin" in plan(warehouse.fact_content_launch(launches, few))
    assert warehouse.fact_content_launch(launches, few).count() == 5
