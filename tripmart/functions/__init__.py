from tripmart.functions.aggregates import (
    count_where,
    null_count,
    null_counts,
    percent_where,
    row_count,
)
from tripmart.functions.scalars import (
    bucket_for,
    col,
    flag_equals,
    label_for,
    minutes_between,
    rounded,
    safe_ratio,
    weekend_flag,
    with_time_parts,
)

__all__ = [
    "bucket_for",
    "col",
    "count_where",
    "flag_equals",
    "label_for",
    "minutes_between",
    "null_count",
    "null_counts",
    "percent_where",
    "rounded",
    "row_count",
    "safe_ratio",
    "weekend_flag",
    "with_time_parts",
]
