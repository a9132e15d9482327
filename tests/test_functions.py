from datetime import date, datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from viewlake import functions as fn


def derived(spark, minutes, rate, planned, actual):
    frame = spark.createDataFrame(
        [(minutes, rate, planned, actual)],
        "watch_minutes double, completion_rate double,"
        " planned_launch_date string, actual_launch_date string",
    )
    row = fn.derive_fields(frame).first()
    return row.watch_hours, row.is_completed, row.launch_delay_days


def test_two_hours_not_completed_no_delay(spark):
    assert derived(spark, 120.0, 0.75, "2024-01-01", "2024-01-01") == (2.0, False, 0)


def test_two_days_late(spark):
    assert derived(spark, 90.0, 0.90, "2024-01-01", "2024-01-03") == (1.5, False, 2)


@pytest.mark.parametrize("actual", [None, "", "soon"])
def test_no_actual_date_gives_no_delay(spark, actual):
    assert derived(spark, 1.0, 0.5, "2024-01-01", actual)[2] is None


@pytest.mark.parametrize("rate, expected", [(0.95, True), (0.9499, False), (None, False)])
def test_completion_threshold(spark, rate, expected):
    assert derived(spark, 1.0, rate, None, None)[1] is expected


def test_hours_round_half_up(spark):
    rows = spark.sql("SELECT explode(array(89.1, 0.3, 5.7, 0.0)) AS m")
    hours = fn.watch_hours(F.col("m").cast("double"))
    assert sorted(r[0] for r in rows.select(hours).collect()) == [0.0, 0.01, 0.1, 1.49]


def test_exact_sum_ignores_order(spark):
    values = [0.1, 1e9, 0.2, -1e9, 0.3] * 50
    results = set()
    for parts in (1, 2, 7):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        frame = frame.repartition(parts)
        results.add(frame.agg(fn.exact_sum(F.col("v"))).first()[0])
    assert results == {30.0}


def test_average_of_nothing_is_null(spark):
    frame = spark.sql("SELECT CAST(NULL AS DOUBLE) AS v WHERE false")
    assert frame.agg(fn.exact_avg(F.col("v"))).first()[0] is None


def test_normalize_shifts_to_utc(spark):
    frame = spark.sql("SELECT TIMESTAMP'2024-03-01 00:30:00' AS event_timestamp")
    row = fn.normalize_timestamps(frame, "Asia/Tokyo").first()
    assert row.event_timestamp == datetime(2024, 2, 29, 15, 30)
    assert (row.event_date, row.year, row.month, row.day) == (
        date(2024, 2, 29), 2024, 2, 29,
    )


def test_calendar(spark):
    frame = spark.sql("SELECT explode(array(DATE'2024-01-07', DATE'2021-01-01')) AS d")
    columns = fn.calendar_columns(F.col("d"))
    assert rows_of(
        frame.select(*(c.alias(n) for n, c in columns.items())),
        "date_key", "week", "day_of_week",
    ) == [(20210101, 53, 6), (20240107, 1, 1)]


def test_percent_of_nothing_is_null(spark):
    frame = spark.sql("SELECT 1 AS a, 0 AS b, 4 AS c")
    row = frame.select(
        fn.percent(F.col("a"), F.col("b")), fn.percent(F.col("a"), F.col("c"))
    ).first()
    assert tuple(row) == (None, 25.0)


def test_sums_keep_small_and_large_values(spark):
    def total(*values):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        return frame.repartition(3).agg(fn.exact_sum(F.col("v"))).first()[0]

    assert total(0.0000004, 0.0000004, 0.0000004) == 0.0000012
    assert total(1e13) == 1e13
    assert total(1e13, 0.25, -1e13, 0.0000004, None) == 0.2500004
    assert total(9e18, 9e18) == 1.8e19
    assert total(1 / 3, 0.5, -7.25) == -6.4166666666666667
    assert total(-0.5, -0.000001) == -0.500001
    assert total(None) is None


def test_sums_of_sums_are_the_sum(spark):
    values = [0.1 * i if i % 3 else i / 7 for i in range(500)]
    frame = spark.createDataFrame([(v, i % 10) for i, v in enumerate(values)], "v double, k int")
    parts = frame.groupBy("k").agg(fn.exact_units(F.col("v")).alias("u"))
    again = parts.agg(fn.from_units(F.sum("u"))).first()[0]
    assert again == frame.agg(fn.exact_sum(F.col("v"))).first()[0]
    assert abs(again - sum(values)) < 1e-9
