from studymart.functions.clinical import (
    ahi,
    ahi_severity,
    band_label,
    month_start,
    normalise_event_type,
    null_if_token,
    percentage,
    ratio,
    stage_rank,
    try_read,
    zero_if_null,
)

__all__ = [
    "ahi",
    "ahi_severity",
    "band_label",
    "month_start",
    "normalise_event_type",
    "null_if_token",
    "percentage",
    "ratio",
    "stage_rank",
    "try_read",
    "zero_if_null",
]
