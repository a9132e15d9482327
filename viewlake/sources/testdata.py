"""Viewing tables derived from the generated test tables by id arithmetic.

See FIXTURES.md for the mapping. Everything is a narrow projection of one
scan, so it runs at any size and on streams too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewlake.schemas import VIEWING_EVENTS

EVENT_COLUMNS = VIEWING_EVENTS.fieldNames()


def _padded(number: str, digits: int) -> str:
    """Leading zeros up to ``digits``; longer numbers stay whole."""
    return f"lpad({number}, greatest({digits}, length({number})), '0')"


_PART = f"concat('CONT-', {_padded('CAST(p_partkey AS STRING)', 5)}) AS content_id"

# The mapping of the event table, column by column.
_CLEAN = {
    "event_id": f"concat('EVT-', {_padded('CAST(event_id AS STRING)', 9)})",
    "customer_id": f"concat('CUST-', {_padded('CAST(user_id AS STRING)', 5)})",
    "content_id": "concat('CONT-', "
    + _padded("regexp_extract(props, '[0-9]+', 0)", 5)
    + ")",
    "event_timestamp": "CAST(ts AS TIMESTAMP)",
    "region": "CASE WHEN user_id % 10 < 4 THEN 'UK' WHEN user_id % 10 < 7 THEN 'US'"
    " WHEN user_id % 10 < 9 THEN 'DE' ELSE 'JP' END",
    "device_type": "CASE WHEN event_id % 20 < 6 THEN 'web'"
    " WHEN event_id % 20 < 12 THEN 'mobile' WHEN event_id % 20 < 16 THEN 'tv'"
    " WHEN event_id % 20 < 19 THEN 'console' ELSE 'tablet' END",
    "event_type": "CASE event_type WHEN 'click' THEN 'play'"
    " WHEN 'view' THEN 'launch-view' WHEN 'signup' THEN 'pause'"
    " WHEN 'purchase' THEN 'complete' ELSE 'skip' END",
    # abs() only turns the source's negative zeros into zeros.
    "watch_minutes": "abs(value)",
    "completion_rate": "CAST(CASE WHEN event_type = 'purchase' THEN 95 + event_id % 6"
    " ELSE event_id * 7 % 95 END AS DOUBLE) / CAST(100 AS DOUBLE)",
    "subscription_type": "CASE WHEN user_id % 10 < 4 THEN 'free'"
    " WHEN user_id % 10 < 7 THEN 'basic' WHEN user_id % 10 < 9 THEN 'premium'"
    " ELSE 'family' END",
    "ingest_date": "CAST(ts AS DATE)",
}

# The faults put into base rows, by event number _e.
_FAULTS = {
    "event_id": "CASE WHEN _e % 700 <> 0 THEN event_id END",
    "event_timestamp": "CASE WHEN _e % 700 <> 100 THEN event_timestamp END",
    "region": "CASE WHEN _e % 700 = 400 OR _e % 2100 = 601 THEN 'XX'"
    " WHEN _e % 700 <> 450 THEN region END",
    "device_type": "CASE WHEN _e % 700 = 500 THEN 'fridge' ELSE device_type END",
    "event_type": "CASE WHEN _e % 700 = 600 OR _e % 2100 = 601"
    " THEN 'unknown_event_type' ELSE event_type END",
    "watch_minutes": "CASE WHEN _e % 700 = 300 THEN CAST(-1 AS DOUBLE)"
    " WHEN _e % 700 = 350 THEN CAST(99999 AS DOUBLE) ELSE watch_minutes END",
    "completion_rate": "CASE WHEN _e % 700 = 200 THEN CAST(1.5 AS DOUBLE)"
    " WHEN _e % 700 <> 550 THEN completion_rate END",
    "subscription_type": "CASE WHEN _e % 700 = 650 THEN 'ultra-premium'"
    " ELSE subscription_type END",
}
_NEAR_COPY = {"event_timestamp": "event_timestamp + INTERVAL '0.25' SECOND"}
_LATE_COPY = {
    "event_id": "concat('LATE-', event_id)",
    "event_timestamp": "event_timestamp - make_dt_interval(CAST(3 + _e % 5 AS INT))",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_events(events: DataFrame) -> DataFrame:
    """Clean viewing events with ingest_date."""
    return events.selectExpr(*(f"{sql} AS {name}" for name, sql in _CLEAN.items()))


def viewing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_events(read_table(spark, sf_dir, "events"))


def _variant(changes: dict[str, str]) -> str:
    """A row as SQL struct: the clean columns with some changed."""
    columns = (f"'{name}', {changes.get(name, name)}" for name in _CLEAN)
    return f"named_struct({', '.join(columns)})"


def map_raw_events(events: DataFrame) -> DataFrame:
    """Viewing events with faults, near copies, exact copies and late copies.

    The base row and its copies are variants of one scanned row. Rules on the
    result see plain columns of the variant and not the fault logic.
    """
    rows = events.selectExpr(
        "event_id AS _e", *(f"{sql} AS {name}" for name, sql in _CLEAN.items())
    )
    variants = ", ".join(
        (
            _variant(_FAULTS),
            f"IF(_e % 400 = 1, {_variant(_NEAR_COPY)}, NULL)",
            f"IF(_e % 2000 = 3, {_variant({})}, NULL)",
            f"IF(_e % 238 = 5, {_variant(_LATE_COPY)}, NULL)",
        )
    )
    exploded = rows.selectExpr(f"explode(array({variants})) AS _row")
    return exploded.where("_row IS NOT NULL").select("_row.*")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_raw_events(read_table(spark, sf_dir, "events"))


_RELEASE = "date_add(DATE'2018-01-01', CAST(p_partkey * 37 % 2200 AS INT))"


def content_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content attributes; a few contents are missing on purpose."""
    parts = read_table(spark, sf_dir, "part")
    return parts.where("p_partkey % 23 <> 22").selectExpr(
        _PART,
        "p_name AS title",
        "p_type AS genre",
        "p_brand AS studio",
        f"CAST({_RELEASE} AS STRING) AS release_date",
        "CASE p_size % 5 WHEN 0 THEN 'movie' WHEN 1 THEN 'series'"
        " WHEN 2 THEN 'documentary' WHEN 3 THEN 'special' ELSE 'short' END"
        " AS content_type",
    )


def content_launch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One launch per content and region."""
    parts = read_table(spark, sf_dir, "part")
    launches = parts.selectExpr(
        "p_partkey", "posexplode(array('UK', 'US', 'DE', 'JP')) AS (_i, region)"
    )
    planned = launches.selectExpr(
        _PART,
        "region",
        "4 * p_partkey + _i AS _place",
        f"date_add({_RELEASE}, CAST((4 * p_partkey + _i) * 11 % 31 AS INT)) AS _planned",
        "CASE WHEN (11 * p_partkey + 5 * _i) % 50 = 7 THEN 'cancelled'"
        " WHEN (7 * p_partkey + 3 * _i) % 20 < 3 THEN 'delayed' ELSE 'on_time' END"
        " AS launch_status",
    )
    delayed = "date_add(_planned, CAST(1 + _place * 13 % 60 AS INT))"
    return planned.selectExpr(
        "content_id",
        "region",
        "CAST(_planned AS STRING) AS planned_launch_date",
        f"CAST(CASE launch_status WHEN 'on_time' THEN _planned WHEN 'delayed'"
        f" THEN {delayed} END AS STRING) AS actual_launch_date",
        "launch_status",
    )
