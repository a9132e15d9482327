from conftest import SMALL, rows_of

from viewlake.operators import validate
from viewlake.plans.transform import check_events
from viewlake.sources import testdata


def reasons(frame):
    return {r.event_id: r.rejection_reason for r in validate.check(frame).collect()}


def test_first_broken_rule_gives_the_reason(make_events):
    rows = make_events(
        {"event_id": "ok"},
        {"event_id": None, "event_timestamp": None},
        {"event_id": "time", "event_timestamp": None, "region": "XX"},
        {"event_id": "rate", "completion_rate": 1.01, "watch_minutes": -1.0},
        {"event_id": "no-rate", "completion_rate": None},
        {"event_id": "minutes", "watch_minutes": 1000.5},
        {"event_id": "no-minutes", "watch_minutes": None},
        {"event_id": "edge", "watch_minutes": 1000.0, "completion_rate": 1.0},
        {"event_id": "enums", "region": "XX", "event_type": "nap"},
        {"event_id": "no-enum", "region": None, "device_type": "fridge"},
        {"event_id": "sub", "subscription_type": "gold"},
    )
    assert reasons(rows) == {
        "ok": None,
        None: "NULL_EVENT_ID",
        "time": "INVALID_TIMESTAMP",
        "rate": "COMPLETION_RATE_OUT_OF_RANGE",
        "no-rate": "NULL_COMPLETION_RATE",
        "minutes": "WATCH_MINUTES_OUT_OF_RANGE",
        "no-minutes": "NULL_WATCH_MINUTES",
        "edge": None,
        "enums": "INVALID_REGION=XX; INVALID_EVENT_TYPE=nap",
        "no-enum": "NULL_REGION; INVALID_DEVICE=fridge",
        "sub": "INVALID_SUBSCRIPTION=gold",
    }


def test_nan_is_out_of_range(make_events):
    nan = float("nan")
    rows = make_events({"event_id": "a", "completion_rate": nan})
    assert reasons(rows) == {"a": "COMPLETION_RATE_OUT_OF_RANGE"}


def test_single_rules_split_everything(make_events):
    rows = make_events(
        {"event_id": None}, {"event_timestamp": None}, {"completion_rate": None},
        {"watch_minutes": -0.1}, {"region": None}, {},
    )
    for rule in (
        validate.validate_required_fields,
        validate.validate_timestamps,
        validate.validate_completion_rate,
        validate.validate_watch_minutes,
        validate.validate_enum_fields,
    ):
        valid, rejected = rule(rows)
        assert (valid.count(), rejected.count()) == (5, 1)
        assert "rejection_reason" not in valid.columns
    valid, rejected = validate.validate_all(rows)
    assert (valid.count(), rejected.count()) == (1, 5)


def test_fixture_counts(spark):
    checked = check_events(testdata.raw_events(spark, SMALL))
    valid, rejected = validate.split(checked)
    assert checked.count() == 1009
    assert valid.count() == 994
    assert rejected.count() == 15
    counts = dict(rows_of(validate.rejection_breakdown(rejected)))
    assert counts["NULL_EVENT_ID"] == 2
    assert counts["INVALID_TIMESTAMP"] == 2
    assert counts["COMPLETION_RATE_OUT_OF_RANGE"] == 2
    assert counts["NULL_COMPLETION_RATE"] == 1
    assert counts["WATCH_MINUTES_OUT_OF_RANGE"] == 2
    assert sum(n for r, n in counts.items() if "INVALID_" in r) - 2 == 5


def test_breakdown_is_ordered(make_events):
    rows = make_events(
        {"event_id": None}, {"event_id": None}, {"watch_minutes": -1.0}
    )
    table = validate.rejection_breakdown(validate.rejected_rows(validate.check(rows)))
    assert [tuple(r) for r in table.collect()] == [
        ("NULL_EVENT_ID", 2), ("WATCH_MINUTES_OUT_OF_RANGE", 1),
    ]


def test_collected_rejects_fill_missing_columns(spark):
    one = spark.sql("SELECT 'a' AS event_id, 'r' AS rejection_reason")
    two = spark.sql("SELECT 's' AS rejection_reason, 'b' AS event_id, 1 AS extra")
    assert rows_of(
        validate.collect_rejects(one, two), "event_id", "rejection_reason", "extra"
    ) == [("a", "r", None), ("b", "s", 1)]
