"""Run log and run state as small Parquet tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGE_COLUMNS = (
    "run_id STRING, run_at TIMESTAMP, stage STRING, status STRING,"
    " input_rows BIGINT, output_rows BIGINT, duration_ms BIGINT, error STRING"
)


@dataclass
class StageResult:
    """What one stage of a run did; a failed stage says so in its status."""

    stage: str
    status: str = "running"
    input_rows: int | None = None
    output_rows: int | None = None
    duration_ms: int | None = None
    error: str | None = None


def stage_rows(
    spark: SparkSession, run_id: str, run_at: datetime, stages: Iterable[StageResult]
) -> DataFrame:
    rows = [
        (
            run_id,
            run_at,
            s.stage,
            s.status,
            s.input_rows,
            s.output_rows,
            s.duration_ms,
            s.error,
        )
        for s in stages
    ]
    return spark.createDataFrame(rows, STAGE_COLUMNS)


def _replace_run(rows: DataFrame, path: str, run_id: str) -> str:
    """Write a run's rows in its own folder, so that repeating it replaces them.

    The folder name starts with a letter, as a bare id could be read back as a
    number or a date.
    """
    (
        rows.withColumn("run", F.lit(f"r_{run_id}"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(path)
    )
    return path


def append_run_metrics(metrics: DataFrame, path: str, run_id: str) -> str:
    """Add the stages of a run to the run log."""
    return _replace_run(metrics, path, run_id)


def save_run_state(
    fingerprints: DataFrame, path: str, run_id: str, run_at: datetime
) -> str:
    """Keep the fingerprints of the partitions that a run wrote."""
    dated = fingerprints.withColumns(
        {"run_id": F.lit(run_id), "run_at": F.lit(run_at).cast("timestamp")}
    )
    return _replace_run(dated, path, run_id)


def run_state(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The fingerprints that one run saved."""
    states = spark.read.parquet(path).where(F.col("run") == f"r_{run_id}")
    return states.drop("run", "run_id", "run_at")


def latest_state(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = ("event_date",),
    without_run: str | None = None,
) -> DataFrame:
    """The latest fingerprint of each partition, by run time.

    ``without_run`` leaves a run out, so that it can be compared to what was
    there before it.
    """
    states = spark.read.parquet(path).drop("run")
    if without_run is not None:
        states = states.where(F.col("run_id") != without_run)
    measures = [c for c in states.columns if c not in (*keys, "run_at", "run_id")]
    newest = states.groupBy(*keys).agg(
        F.max(F.struct("run_at", "run_id", *measures)).alias("_state")
    )
    return newest.select(*keys, *(f"_state.{m}" for m in measures))
