"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the local cores. Every
query runs in full twice in one session. ``queries`` and ``value`` are the second
runs; ``first_runs`` are the first ones, which also compile code. ``daily_run`` is a lake
of ``BENCH_RUN_ROWS`` rows: its first run over all dates, and a run over three of them
again, by stage; it is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import date, datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from catalog.queries import QUERIES  # noqa: E402
from viewlake.functions import normalize_timestamps  # noqa: E402
from viewlake.plans import daily_run, formats  # noqa: E402
from viewlake.plans.zones import Zones  # noqa: E402
from viewlake.session import build_session, working_folder  # noqa: E402
from viewlake.sources import land_raw, testdata  # noqa: E402

HEADLINES = (
    "validate_rejected",
    "dedup_unique",
    "dedup_duplicates",
    "enrich_metadata",
    "enrich_launch",
    "daily_aggregate",
    "end_to_end_daily",
    "top_content_uk",
    "daily_trend_by_region",
    "completion_by_device",
    "region_breakdown",
    "kpi_cards",
    "top_titles",
    "launch_success",
    "fact_viewing",
    "star_read",
    "verify_warehouse",
    "quality_metrics",
    "skew_profile",
    "fingerprint_fast",
    "written_partitions",
    "lineitem_daily",
    "lineitem_dedup",
    "lineitem_superseded",
    "lineitem_star",
)


def run_fully(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def time_daily_run(spark, sf_dir: str, rows: int) -> dict:
    """A first run over all landed dates, and one over three of them again."""
    events = testdata.read_table(spark, sf_dir, "events")
    size = events.count()
    copies = F.explode(F.sequence(F.lit(0), F.lit((rows - 1) // size)))
    many = events.withColumn("_n", copies)
    many = many.withColumn("event_id", F.col("event_id") + F.col("_n") * size).drop("_n")
    zones = Zones(working_folder(spark, "bench-lake"))
    for frame, path in (
        (testdata.content_metadata(spark, sf_dir), zones.metadata),
        (testdata.content_launch(spark, sf_dir), zones.launch),
    ):
        frame.write.option("header", True).csv(path)
    land_raw(testdata.map_raw_events(many), zones.raw_events)
    three = [date(2024, 1, d) for d in (28, 29, 30)]
    timed = {}
    for name, days in (("first", None), ("three_dates_again", three)):
        began = time.perf_counter()
        run = daily_run.run_incremental(spark, zones, name, datetime(2024, 2, 1), days)
        timed[name] = {
            "rows": run.stages[0].input_rows,
            "seconds": round(time.perf_counter() - began, 2),
            "event_dates": len(run.event_dates),
            "stages": {s.stage: round(s.duration_ms / 1000, 2) for s in run.stages},
        }
    return timed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    firsts: dict[str, float] = {}
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        for results in (firsts, seconds):
            began = time.perf_counter()
            run_fully(QUERIES[name](spark, sf_dir))
            results[name] = round(time.perf_counter() - began, 3)

    events = normalize_timestamps(testdata.viewing_events(spark, sf_dir))
    trial = formats.write_both_forms(events, working_folder(spark, "bench"))
    forms = formats.read_forms(spark, trial)
    question = formats.watch_hours_query("UK", date(2024, 1, 1), date(2024, 1, 7))
    for results in (firsts, seconds):
        for name, took in formats.time_forms(forms, question).items():
            results[f"watch_hours_uk_on_{name}"] = round(took, 3)

    rows = int(os.environ.get("BENCH_RUN_ROWS", 500_000))
    runs = time_daily_run(spark, sf_dir, rows)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_runs": firsts,
                "daily_run": runs,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
