"""Column functions: text cells in, typed values out; aggregates over typed values."""

from varve.functions.cells import (
    HOUR_MINUTE,
    day_bound,
    guard,
    label,
    locale_double,
    null_token,
    safe,
    strict_date,
    trace_flag,
    trace_value,
)
from varve.functions.measures import (
    count_where,
    mean_where,
    nan_count,
    null_count,
    round_half_up,
    safe_ratio,
)

__all__ = [
    "HOUR_MINUTE",
    "count_where",
    "day_bound",
    "guard",
    "label",
    "locale_double",
    "mean_where",
    "nan_count",
    "null_count",
    "null_token",
    "round_half_up",
    "safe",
    "safe_ratio",
    "strict_date",
    "trace_flag",
    "trace_value",
]
