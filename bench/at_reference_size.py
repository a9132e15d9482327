"""

The event table is repeated with new ids up to ROWS rows (500,000 by default),
landed as CSV and processed by one run on local[CPUS] (4 by default). The format
comparison uses FORMAT_ROWS rows (5,000,000 by default). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import date, datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from viewlake.functions import normalize_timestamps  # noqa: E402
from viewlake.plans import daily_run, formats  # noqa: E402
from viewlake.plans.zones import Zones  # noqa: E402
from viewlake.session import build_session, working_folder  # noqa: E402
from viewlake.sources import land_raw, testdata  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
ROWS = int(os.environ.get("BENCH_ROWS", 500_000))
FORMAT_ROWS = int(os.environ.get("BENCH_FORMAT_ROWS", 5_000_000))


def repeated_events(spark, rows: int):
    """The event table again and again under new ids, ``rows`` rows or more."""
    events = testdata.read_table(spark, SF_DIR, "events")
    size = events.count()
    copies = F.sequence(F.lit(0), F.lit((rows - 1) // size))
    many = events.repartition(int(CPUS)).withColumn("_n", F.explode(copies))
    return many.withColumn("event_id", F.col("event_id") + F.col("_n") * size).drop("_n")


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "4g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    zones = Zones(working_folder(spark, "bench-lake"))
    testdata.content_metadata(spark, SF_DIR).write.option("header", True).csv(
        zones.metadata
    )
    testdata.content_launch(spark, SF_DIR).write.option("header", True).csv(zones.launch)
    land_raw(testdata.map_raw_events(repeated_events(spark, ROWS)), zones.raw_events)

    began = time.perf_counter()
    result = daily_run.run_incremental(spark, zones, "bench", datetime(2024, 2, 1))
    run_seconds = time.perf_counter() - began

    began = time.perf_counter()
    days = [date(2024, 1, d) for d in (28, 29, 30)]
    again = daily_run.run_incremental(
        spark, zones, "bench-again", datetime(2024, 2, 2), days
    )
    again_seconds = time.perf_counter() - began

    events = normalize_timestamps(
        testdata.map_events(repeated_events(spark, FORMAT_ROWS))
    )
    trial = formats.write_both_forms(events, working_folder(spark, "bench-forms"))
    forms = formats.read_forms(spark, trial)
    week = ("UK", date(2024, 1, 1), date(2024, 1, 7))
    formats.time_forms(forms, formats.watch_hours_query(*week))
    seconds = formats.time_forms(forms, formats.watch_hours_query(*week))
    print(
        json.dumps(
            {
                "cpus": int(CPUS),
                "run_rows": result.stages[0].input_rows,
                "run_seconds": round(run_seconds, 2),
                "run_stages": {
                    s.stage: round(s.duration_ms / 1000, 2) for s in result.stages
                },
                "three_days_again_rows": again.stages[0].input_rows,
                "three_days_again_seconds": round(again_seconds, 2),
                "format_rows": forms["parquet"].count(),
                "watch_hours_uk_seconds": {k: round(v, 2) for k, v in seconds.items()},
                "files_opened": formats.files_read(forms, *week),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
