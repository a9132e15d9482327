from viewlake.streaming.live import (
    check_arrivals,
    Deduplicated,
    count_into,
    dedup_available,
    dedup_stream,
    hourly_counts,
    open_files,
    open_raw_events,
    read_counts,
    run_available,
    split_late,
)

__all__ = [
    "Deduplicated",
    "check_arrivals",
    "count_into",
    "dedup_available",
    "dedup_stream",
    "hourly_counts",
    "open_files",
    "open_raw_events",
    "read_counts",
    "run_available",
    "split_late",
]
