from lakemill.functions.columns import (
    conditional_sum,
    empty_if_null,
    full_name,
    is_missing,
    last_url_segment,
    line_total_error,
    pass_or_fail,
    typed,
    us_date,
)

__all__ = [
    "conditional_sum",
    "empty_if_null",
    "full_name",
    "is_missing",
    "last_url_segment",
    "line_total_error",
    "pass_or_fail",
    "typed",
    "us_date",
]
