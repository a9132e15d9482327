from viewlake.sinks.files import (
    partition_report,
    write_csv_baseline,
    write_dead_letter,
    write_parquet_baseline,
    write_partitioned,
)
from viewlake.sinks.runlog import (
    append_run_metrics,
    latest_state,
    run_state,
    save_run_state,
    stage_rows,
)

__all__ = [
    "append_run_metrics",
    "latest_state",
    "partition_report",
    "run_state",
    "save_run_state",
    "stage_rows",
    "write_csv_baseline",
    "write_dead_letter",
    "write_parquet_baseline",
    "write_partitioned",
]
