"""Field rules that split events into valid rows and rejected rows with a reason.

A rule says when a row is good and, for the others, why not. All rules are
evaluated in one narrow pass; a row keeps the reason of the first rule it
breaks. A NULL measure or enum is rejected under its own code, so valid and
rejected rows always add up to the input.

Valid rows are selected by the plain conditions and not by the missing reason,
so that the conditions reach a Parquet scan as filters.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlake.schemas import (
    CORRUPT_RECORD,
    DEVICE_TYPES,
    EVENT_TYPES,
    LAUNCH_STATUSES,
    REGIONS,
    SUBSCRIPTION_TYPES,
)

REASON = "rejection_reason"

# Closed ranges of the measures.
COMPLETION_RATE_RANGE = (0.0, 1.0)
WATCH_MINUTES_RANGE = (0.0, 1000.0)

# The enum columns, the label used in reasons, and their domains.
ENUMS = (
    ("region", "REGION", REGIONS),
    ("device_type", "DEVICE", DEVICE_TYPES),
    ("event_type", "EVENT_TYPE", EVENT_TYPES),
    ("subscription_type", "SUBSCRIPTION", SUBSCRIPTION_TYPES),
)


@dataclass(frozen=True)
class Rule:
    """A row is good where ``holds`` is true; NULL counts as broken."""

    holds: Column
    reason: Column


def required_rule(column: str = "event_id") -> Rule:
    return Rule(F.col(column).isNotNull(), F.lit(f"NULL_{column.upper()}"))


def timestamp_rule(column: str = "event_timestamp") -> Rule:
    return Rule(F.col(column).isNotNull(), F.lit("INVALID_TIMESTAMP"))


def range_rule(column: str, low: float, high: float) -> Rule:
    value, name = F.col(column), column.upper()
    return Rule(
        value.between(low, high),
        F.when(value.isNull(), f"NULL_{name}").otherwise(f"{name}_OUT_OF_RANGE"),
    )


def enum_rule(enums: Iterable[tuple[str, str, tuple[str, ...]]] = ENUMS) -> Rule:
    """The reason lists all enum violations of a row, joined by "; "."""
    enums = list(enums)
    known = {column: F.col(column).isin(*domain) for column, _, domain in enums}
    parts = [
        F.when(F.col(column).isNull(), f"NULL_{label}").when(
            ~known[column], F.concat(F.lit(f"INVALID_{label}="), F.col(column))
        )
        for column, label, _ in enums
    ]
    return Rule(reduce(and_, known.values()), F.concat_ws("; ", *parts))


def event_rules() -> list[Rule]:
    return [
        required_rule(),
        timestamp_rule(),
        range_rule("completion_rate", *COMPLETION_RATE_RANGE),
        range_rule("watch_minutes", *WATCH_MINUTES_RANGE),
        enum_rule(),
    ]


def well_formed_rule() -> Rule:
    """Rows that had as many fields as the schema."""
    return Rule(F.col(CORRUPT_RECORD).isNull(), F.lit("MALFORMED_ROW"))


def metadata_rules() -> list[Rule]:
    return [well_formed_rule(), required_rule("content_id")]


def launch_rules() -> list[Rule]:
    """Keys, and the domain of the status, which may be unknown yet."""
    status = F.col("launch_status")
    known = F.coalesce(status.isin(*LAUNCH_STATUSES), F.lit(True))
    return [
        well_formed_rule(),
        required_rule("content_id"),
        required_rule("region"),
        Rule(known, F.concat(F.lit("INVALID_LAUNCH_STATUS="), status)),
    ]


def is_valid(rules: Iterable[Rule] | None = None) -> Column:
    """True for good rows, false or NULL for others."""
    return reduce(and_, (rule.holds for rule in rules or event_rules()))


def check(rows: DataFrame, rules: Iterable[Rule] | None = None) -> DataFrame:
    """Add the reason column: NULL on valid rows."""
    reasons = [
        F.when(rule.holds, None).otherwise(rule.reason)
        for rule in rules or event_rules()
    ]
    return rows.withColumn(REASON, F.coalesce(*reasons))


def split(
    checked: DataFrame, rules: Iterable[Rule] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of rows checked with the rules."""
    return valid_rows(checked, rules), rejected_rows(checked, rules)


def valid_rows(checked: DataFrame, rules: Iterable[Rule] | None = None) -> DataFrame:
    return checked.where(is_valid(rules)).drop(REASON)


def rejected_rows(checked: DataFrame, rules: Iterable[Rule] | None = None) -> DataFrame:
    return checked.where(~F.coalesce(is_valid(rules), F.lit(False)))


def _by_rule(rows: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    return split(check(rows, [rule]), [rule])


def validate_required_fields(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _by_rule(rows, required_rule())


def validate_timestamps(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _by_rule(rows, timestamp_rule())


def validate_completion_rate(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _by_rule(rows, range_rule("completion_rate", *COMPLETION_RATE_RANGE))


def validate_watch_minutes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _by_rule(rows, range_rule("watch_minutes", *WATCH_MINUTES_RANGE))


def validate_enum_fields(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _by_rule(rows, enum_rule())


def validate_all(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(check(rows))


def rejection_breakdown(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason, most frequent first."""
    return (
        rejected.groupBy(REASON)
        .agg(F.count("*").alias("rejected_rows"))
        .orderBy(F.desc("rejected_rows"), REASON)
    )


def collect_rejects(*rejects: DataFrame) -> DataFrame:
    """One dead-letter table from several, columns matched by name."""
    first, *others = rejects
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
