from viewlake.sources.calendar import date_series
from viewlake.sources.lake import open_view, read_lake, read_partition, run_sql
from viewlake.sources.paths import drop_partitions, partition_dates, partition_paths
from viewlake.sources.raw import (
    land_raw,
    read_content_launch,
    read_content_metadata,
    read_viewing_events,
)

__all__ = [
    "date_series",
    "drop_partitions",
    "land_raw",
    "open_view",
    "partition_dates",
    "partition_paths",
    "read_content_launch",
    "read_content_metadata",
    "read_lake",
    "read_partition",
    "read_viewing_events",
    "run_sql",
]
