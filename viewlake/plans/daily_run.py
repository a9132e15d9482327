"""The daily run: take in new arrivals and correct whatever they touch.

Arrivals are dated by ``ingest_date`` and published by ``event_date``, so a late
event changes an old partition. A run therefore

1. writes the arrivals, normalized and checked, by status and ingest date;
2. collects the ids that may change: valid arrivals, and everything published
   earlier from the same ingest dates (for a repeated or corrected date);
3. finds all checked rows with those ids, in whatever ingest date, and picks the
   winners and losers among them anew;
4. rewrites the event dates concerned: published rows of other ids stay, those of
   the changed ids are replaced.

Rows of other ids cannot change, so the result equals a full recompute, and
running a date again gives the same tables. Step 3 finds the ingest and event dates of
the ids in an index that is pruned to the folders they fall in; see ``id_index``.

Days are also rewritten when the metadata or a launch of a content they hold has
changed; see ``references``.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewlake.operators.dedup import keep_latest, superseded
from viewlake.operators.fingerprint import compare_fingerprints, fingerprint
from viewlake.operators.lateness import backfill_range, parse_date_range
from viewlake.operators.quality import counted
from viewlake.operators.rollup import aggregate_daily
from viewlake.operators.validate import REASON, is_valid
from viewlake.plans import id_index
from viewlake.plans.references import (
    References,
    dates_to_restate,
    load_references,
    mark_published,
)
from viewlake.plans.refresh import refresh_warehouse
from viewlake.plans.transform import check_events, enrich
from viewlake.plans.zones import (
    Zones,
    read_if_filled,
    replace_partitions,
    side_by_side,
)
from viewlake.schemas import CORRUPT_RECORD
from viewlake.session import working_folder
from viewlake.sinks.files import PARTITION_KEYS, write_partitioned
from viewlake.sinks.runlog import (
    StageResult,
    append_run_metrics,
    latest_state,
    run_state,
    save_run_state,
    stage_rows,
)
from viewlake.sources.headers import read_landed_events
from viewlake.sources.paths import (
    dates_frame,
    drop_folder,
    drop_partitions,
    partition_dates,
)
from viewlake.sources.raw import read_viewing_events

ID = "event_id"

# What the search for changed rows reads of the published tables.
PLACES = "event_id STRING, ingest_date DATE, event_date DATE"


@dataclass
class RunResult:
    run_id: str
    ingest_dates: list[date]
    event_dates: list[date] = field(default_factory=list)
    stages: list[StageResult] = field(default_factory=list)


@contextmanager
def _stage(result: RunResult, name: str) -> Iterator[StageResult]:
    """Record a stage with its duration; an error marks it as failed."""
    stage = StageResult(name)
    result.stages.append(stage)
    began = time.perf_counter()
    try:
        yield stage
        stage.status = "success"
    except Exception as error:
        stage.status = "failed"
        stage.error = str(error)
        raise
    finally:
        stage.duration_ms = int((time.perf_counter() - began) * 1000)


def pending_dates(spark: SparkSession, zones: Zones) -> list[date]:
    """Landed ingest dates that no finished run has taken in."""
    landed = partition_dates(spark, zones.raw_events, "ingest_date")
    done = set(partition_dates(spark, zones.processed, "ingest_date"))
    return [d for d in landed if d not in done]


def run_incremental(
    spark: SparkSession,
    zones: Zones,
    run_id: str,
    run_at: datetime,
    ingest_dates: Iterable[date] | None = None,
) -> RunResult:
    """Process the pending ingest dates, or the given ones again.

    Copies of an id are looked for through all history.
    """
    if ingest_dates is None:
        ingest_dates = pending_dates(spark, zones)
    result = RunResult(run_id, sorted(ingest_dates))
    try:
        _process(spark, zones, result, run_at)
    finally:
        if result.stages:
            metrics = stage_rows(spark, run_id, run_at, result.stages)
            append_run_metrics(metrics, zones.runs, run_id)
    return result


def _process(
    spark: SparkSession,
    zones: Zones,
    result: RunResult,
    run_at: datetime,
) -> None:
    days = result.ingest_dates
    references = None
    if not days:
        # Without arrivals there is something to do if a reference table changed.
        if not partition_dates(spark, zones.processed, "ingest_date"):
            return
        references = load_references(spark, zones)
        left = partition_dates(spark, zones.unfinished, "event_date")
        if not left and not dates_to_restate(spark, zones, references):
            mark_published(spark, zones, references)
            return
    # Until the run is done its dates count as not processed.
    marks = [(d.isoformat(),) for d in days]
    drop_partitions(spark, zones.processed, ("ingest_date",), marks)

    with _stage(result, "check") as stage:
        valid, stage.input_rows, stage.output_rows = _write_checked(spark, zones, days)

    landed = partition_dates(spark, zones.raw_events, "ingest_date")
    scratch = working_folder(spark, "changed-ids")
    try:
        with _stage(result, "select"):
            # Without published days there is nothing that references could restate.
            if references is None and partition_dates(spark, zones.daily, "event_date"):
                reach, references = side_by_side(
                    lambda: _note_arrivals(spark, zones, valid, days),
                    lambda: load_references(spark, zones),
                )
            else:
                reach = _note_arrivals(spark, zones, valid, days)
            if set(landed) <= set(days):
                changed = None
                rows, events = _everything(spark, zones, valid)
            else:
                changed = _write_changed_ids(spark, zones, valid, days, reach, scratch)
                rows, events = _candidates(spark, zones, valid, days, reach, changed)
            # What a broken run has rewritten may not be found by its rows again.
            left = partition_dates(spark, zones.unfinished, "event_date")
            if references is not None:
                left += dates_to_restate(spark, zones, references)
            events = result.event_dates = sorted({*events, *left})
            _note_unfinished(spark, zones, events)
        if events:
            with _stage(result, "publish") as stage:
                references = references or load_references(spark, zones)
                enriched, stage.output_rows = _publish(
                    spark, zones, rows, changed, events, references
                )
    finally:
        drop_folder(spark, scratch)
    if events:
        _follow_up(spark, zones, result, enriched, references, run_at)
    with _stage(result, "state"):
        if references is not None:
            mark_published(spark, zones, references)
        done = dates_frame(spark, days, "ingest_date")
        write_partitioned(
            done.withColumn("run_id", F.lit(result.run_id)),
            zones.processed,
            ("ingest_date",),
        )
        drop_folder(spark, zones.unfinished)


def _note_arrivals(
    spark: SparkSession, zones: Zones, valid: DataFrame, days: list[date]
) -> dict[date, set[date]]:
    """Add the arrivals to the index of ids, and return the event dates that earlier
    runs of the same ingest dates may have written to.

    The dates of this run are noted before its rows are published, so that a run that
    breaks off is found as well.
    """
    arrivals = valid.select(ID, "ingest_date", "event_date")
    is_built = id_index.is_built(spark, zones.id_index)
    if is_built:
        arrivals = _from_dates(arrivals, days)
        id_index.add(arrivals, zones.id_index)
    else:
        # In a lake from before there was an index all rows have to be found.
        id_index.build(arrivals, zones.id_index)
    before = _reach(spark, zones, days)
    reach = {day: set(dates) for day, dates in before.items()}
    for row in arrivals.select("ingest_date", "event_date").distinct().collect():
        reach.setdefault(row["ingest_date"], set()).add(row["event_date"])
    if reach:
        pairs = [(day, e) for day, dates in reach.items() for e in dates]
        known = spark.createDataFrame(pairs, "ingest_date DATE, event_date DATE")
        write_partitioned(known, zones.reach, ("ingest_date",))
    return before if is_built else reach


def _reach(
    spark: SparkSession, zones: Zones, days: list[date]
) -> dict[date, set[date]]:
    columns = "event_date DATE, ingest_date DATE"
    held = read_if_filled(spark, zones.reach, "ingest_date", columns)
    reach: dict[date, set[date]] = {}
    if held is not None:
        for row in _from_dates(held, days).distinct().collect():
            reach.setdefault(row["ingest_date"], set()).add(row["event_date"])
    return reach


def _note_unfinished(spark: SparkSession, zones: Zones, events: list[date]) -> None:
    marks = dates_frame(spark, events, "event_date").withColumn("open", F.lit(True))
    write_partitioned(marks, zones.unfinished, ("event_date",))


def _follow_up(
    spark: SparkSession,
    zones: Zones,
    result: RunResult,
    enriched: DataFrame,
    references: References,
    run_at: datetime,
) -> None:
    """Bring the aggregate, the warehouse and the fingerprints up to date."""
    events = result.event_dates
    touched = enriched.where(F.col("event_date").isin(events))

    def aggregate() -> None:
        with _stage(result, "aggregate"):
            daily = aggregate_daily(touched, partials=True)
            replace_partitions(daily, zones.daily, ("event_date",), _texts(events))

    def load_warehouse() -> None:
        with _stage(result, "warehouse"):
            refresh_warehouse(
                spark,
                zones,
                touched,
                events,
                run_at,
                references.metadata,
                references.launch,
            )

    def take_fingerprint() -> None:
        with _stage(result, "fingerprint"):
            state = fingerprint(touched, ["event_date"])
            save_run_state(state, zones.fingerprints, result.run_id, run_at)

    side_by_side(aggregate, load_warehouse, take_fingerprint)


def _texts(days: Iterable[date]) -> set[str]:
    return {d.isoformat() for d in days}


def _write_checked(
    spark: SparkSession, zones: Zones, days: list[date]
) -> tuple[DataFrame, int, int]:
    """Write arrivals by status and ingest date; returns the valid rows of all
    dates, and how many of these arrivals were read and valid."""
    if not days:
        schema = check_events(read_viewing_events(spark, zones.raw_events)).schema
        return _valid(spark, zones, schema.add("status", "string")), 0, 0
    # Files whose columns do not fit stop the run here, before anything is touched.
    landed = read_landed_events(spark, zones.raw_events, days, zones.event_columns)
    for status in ("valid", "rejected"):
        drop_partitions(
            spark,
            zones.checked,
            ("status", "ingest_date"),
            [(status, d.isoformat()) for d in days],
        )
    checked = check_events(landed)
    rows, seen = counted(checked, "arrivals", valid=F.count_if(is_valid()))
    rows = rows.withColumn(
        "status", F.when(is_valid(), "valid").otherwise("rejected")
    )
    write_partitioned(rows, zones.checked, ("status", "ingest_date"))
    counts = seen.get
    return _valid(spark, zones, rows.schema), counts["rows"], counts["valid"]


def _valid(spark: SparkSession, zones: Zones, schema: StructType) -> DataFrame:
    written = spark.read.schema(schema).parquet(zones.checked)
    valid = written.where(F.col("status") == "valid")
    return valid.drop("status", REASON, CORRUPT_RECORD)


def _from_dates(rows: DataFrame, days: Iterable[date]) -> DataFrame:
    return rows.where(F.col("ingest_date").isin(list(days)))


def _published_from(
    spark: SparkSession, zones: Zones, days: list[date], reach: dict[date, set[date]]
) -> list[DataFrame]:
    """Places of the rows published or set aside earlier from the ingest dates.

    Only event dates that the ingest dates reach are read, so nothing is for dates
    that are new.
    """
    dates = {e for d in days for e in reach.get(d, ())}
    if not dates:
        return []
    tables = (
        read_if_filled(spark, path, "event_date", PLACES)
        for path in (zones.enriched, zones.duplicates)
    )
    columns = [c.split()[0] for c in PLACES.split(", ")]
    touched = F.col("event_date").isin(sorted(dates))
    return [
        _from_dates(t.where(touched).select(columns), days)
        for t in tables
        if t is not None
    ]


def _write_changed_ids(
    spark: SparkSession,
    zones: Zones,
    valid: DataFrame,
    days: list[date],
    reach: dict[date, set[date]],
    scratch: str,
) -> DataFrame:
    ids = _from_dates(valid, days).select(ID)
    for rows in _published_from(spark, zones, days, reach):
        ids = ids.unionByName(rows.select(ID))
    ids.distinct().write.parquet(scratch)
    return spark.read.schema(ids.schema).parquet(scratch)


def _everything(
    spark: SparkSession, zones: Zones, valid: DataFrame
) -> tuple[DataFrame, list[date]]:
    """All valid rows and all event dates, for a run over every landed date."""
    events = {r[0] for r in valid.select("event_date").distinct().collect()}
    for path in (zones.enriched, zones.duplicates):
        events |= set(partition_dates(spark, path, "event_date"))
    return valid, sorted(events)


def _candidates(
    spark: SparkSession,
    zones: Zones,
    valid: DataFrame,
    days: list[date],
    reach: dict[date, set[date]],
    changed: DataFrame,
) -> tuple[DataFrame, list[date]]:
    """All valid rows with a changed id, and every event date concerned.

    The index names the dates that may hold the ids; full rows are then read only from
    those ingest dates, and their ids are compared.
    """
    places = id_index.places_of(changed, zones.id_index)
    for rows in _published_from(spark, zones, days, reach):
        places = places.unionByName(rows.select("ingest_date", "event_date"))
    # Date pairs: their number grows with the days kept, not with the rows.
    found = places.distinct().collect()
    arrived = {r["ingest_date"] for r in found}
    rows = _from_dates(valid, arrived).join(changed, ID, "left_semi")
    return rows, sorted({r["event_date"] for r in found})


def _publish(
    spark: SparkSession,
    zones: Zones,
    rows: DataFrame,
    changed: DataFrame | None,
    events: list[date],
    references: References,
) -> tuple[DataFrame, int]:
    """Rewrite the enriched rows and the duplicates of the event dates; returns the
    enriched table and the rows written.

    Published rows whose id did not change are kept; ``changed`` is None when
    every id may have changed.
    """

    def with_kept(path: str, fresh: DataFrame) -> DataFrame:
        before = read_if_filled(spark, path, "event_date", fresh.schema)
        if changed is None or before is None:
            return fresh
        touched = before.where(F.col("event_date").isin(events))
        kept = touched.select(*fresh.columns)
        return kept.join(changed, ID, "left_anti").unionByName(fresh)

    winners = with_kept(zones.enriched, keep_latest(rows, [ID]))
    losers = with_kept(zones.duplicates, superseded(rows, [ID]))
    texts = _texts(events)
    enriched = enrich(winners, references.metadata, references.launch)
    side_by_side(
        lambda: replace_partitions(losers, zones.duplicates, ("event_date",), texts),
        lambda: replace_partitions(enriched, zones.enriched, PARTITION_KEYS, texts),
    )
    table = spark.read.schema(enriched.schema).parquet(zones.enriched)
    # Counted from the file footers of the partitions written.
    return table, table.where(F.col("event_date").isin(events)).count()


def run_backfill(
    spark: SparkSession,
    zones: Zones,
    run_id: str,
    run_at: datetime,
    start: str,
    end: str | None = None,
    today: date | None = None,
) -> tuple[RunResult, DataFrame]:
    """Process a range of ingest dates again, "all" for every landed one.

    One job takes in the whole range. The second result has the rows of each
    date, -1 where nothing has landed.
    """
    landed = partition_dates(spark, zones.raw_events, "ingest_date")
    wanted = parse_date_range(start, end, today) or landed
    if not wanted:
        raise ValueError("nothing has landed yet")
    taken = sorted(set(wanted) & set(landed))
    result = run_incremental(spark, zones, run_id, run_at, taken)
    schema = "ingest_date DATE"
    arrivals = read_if_filled(spark, zones.checked, "status", schema)
    if arrivals is None:
        arrivals = spark.createDataFrame([], schema)
    return result, backfill_range(spark, arrivals, min(wanted), max(wanted))


def compare_to_previous(
    spark: SparkSession, zones: Zones, run_id: str
) -> DataFrame:
    """The event dates a run wrote against their state before it."""
    after = run_state(spark, zones.fingerprints, run_id)
    before = latest_state(spark, zones.fingerprints, without_run=run_id)
    before = before.join(after.select("event_date"), "event_date", "left_semi")
    return compare_fingerprints(before, after, ["event_date"])
