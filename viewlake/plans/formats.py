"""The same rows as CSV and as partitioned Parquet, and one query on both."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlake.operators.marts import filter_window, watch_hours_by_content
from viewlake.sinks.files import write_csv_baseline, write_partitioned


@dataclass(frozen=True)
class FormatTrial:
    """Where the two forms of a dataset are."""

    csv: str
    parquet: str


def write_both_forms(events: DataFrame, base: str) -> FormatTrial:
    """Write events as unpartitioned CSV and as Parquet by date and region."""
    return FormatTrial(
        csv=write_csv_baseline(events, f"{base}/csv"),
        parquet=write_partitioned(events, f"{base}/parquet"),
    )


def read_forms(spark: SparkSession, trial: FormatTrial) -> dict[str, DataFrame]:
    parquet = spark.read.parquet(trial.parquet)
    # Columns are given by name, since Parquet returns partition columns last.
    header = spark.read.options(header=True, escape='"').csv(trial.csv).columns
    kinds = dict(parquet.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in header)
    csv = spark.read.schema(schema).options(header=True, escape='"').csv(trial.csv)
    return {"csv": csv, "parquet": parquet}


def watch_hours_query(region: str, start: date, end: date) -> Callable:
    """The representative query: hours by content in one region and one week."""
    return lambda events: watch_hours_by_content(
        filter_window(events, [region], start, end)
    )


def compare_answers(forms: dict[str, DataFrame], query: Callable) -> DataFrame:
    """The answers of both forms, told apart by ``source_format``."""
    csv, parquet = (
        query(forms[name]).withColumn("source_format", F.lit(name))
        for name in ("csv", "parquet")
    )
    return csv.unionByName(parquet)


def time_forms(forms: dict[str, DataFrame], query: Callable) -> dict[str, float]:
    """Seconds of a full run of the query on each form."""
    seconds = {}
    for name, frame in forms.items():
        began = time.perf_counter()
        query(frame).write.format("noop").mode("overwrite").save()
        seconds[name] = time.perf_counter() - began
    return seconds


def files_read(forms: dict[str, DataFrame], region: str, start: date, end: date):
    """Files each form has to open for the query's filters."""
    counts = {}
    for name, frame in forms.items():
        kept = filter_window(frame, [region], start, end) if name == "parquet" else frame
        counts[name] = kept.select("_metadata.file_path").distinct().count()
    return counts
