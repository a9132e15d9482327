from viewlake.functions.dates import (
    calendar_columns,
    date_key,
    lateness_days,
    normalize_timestamps,
    parse_date,
)
from viewlake.functions.exact import (
    exact_avg,
    exact_sum,
    exact_units,
    from_units,
    percent,
    round_half_up,
)
from viewlake.functions.measures import (
    completed_views,
    derive_fields,
    is_completed,
    launch_delay_days,
    watch_hours,
)

__all__ = [
    "calendar_columns",
    "completed_views",
    "date_key",
    "derive_fields",
    "exact_avg",
    "exact_sum",
    "exact_units",
    "from_units",
    "is_completed",
    "lateness_days",
    "launch_delay_days",
    "normalize_timestamps",
    "parse_date",
    "percent",
    "round_half_up",
    "watch_hours",
]
