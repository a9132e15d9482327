"""From raw events to enriched events, daily aggregate and dead letter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from viewlake.functions import derive_fields, is_completed, normalize_timestamps
from viewlake.operators.dedup import keep_latest, superseded
from viewlake.operators.enrich import enrich_with_launch, enrich_with_metadata
from viewlake.operators.rollup import aggregate_daily
from viewlake.operators.validate import (
    check,
    collect_rejects,
    rejected_rows,
    valid_rows,
)


@dataclass(frozen=True)
class Transformed:
    enriched: DataFrame
    daily: DataFrame
    dead_letter: DataFrame


def check_events(raw: DataFrame) -> DataFrame:
    """Normalized events with the rejection reason; narrow."""
    return check(normalize_timestamps(raw))


def enrich(events: DataFrame, metadata: DataFrame, launch: DataFrame) -> DataFrame:
    """Both reference joins and the derived measures."""
    joined = enrich_with_launch(enrich_with_metadata(events, metadata), launch)
    return derive_fields(joined)


def transform(raw: DataFrame, metadata: DataFrame, launch: DataFrame) -> Transformed:
    """Validate first, then deduplicate, enrich, derive and aggregate.

    Rejected rows and superseded duplicates both end up in the dead letter.
    """
    checked = check_events(raw)
    valid = valid_rows(checked)
    kept = keep_latest(valid)
    return Transformed(
        enriched=enrich(kept, metadata, launch),
        # The left joins neither add nor drop events and the roll-up reads none of
        # their columns, so it goes without them.
        daily=aggregate_daily(kept.withColumn("is_completed", is_completed())),
        dead_letter=collect_rejects(rejected_rows(checked), superseded(valid)),
    )
