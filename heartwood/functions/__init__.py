"""Column expressions shared by the operators."""

from heartwood.functions.labels import (
    classify_status,
    due_in_days,
    recommended_action,
    risk_drivers,
)
from heartwood.functions.numeric import (
    clip_score,
    count_where,
    np_round,
    py_round,
    sql_average,
    view_rows,
    weighted_count,
    whole_number_text,
)
from heartwood.functions.temporal import (
    as_of_day,
    as_of_moment,
    elapsed_days,
    elapsed_micros,
    elapsed_hours_rounded,
    next_renewal_date,
    sla_breached,
    to_datetime,
)

__all__ = [
    "as_of_day",
    "as_of_moment",
    "classify_status",
    "clip_score",
    "count_where",
    "due_in_days",
    "elapsed_days",
    "elapsed_hours_rounded",
    "elapsed_micros",
    "next_renewal_date",
    "np_round",
    "py_round",
    "recommended_action",
    "risk_drivers",
    "sla_breached",
    "sql_average",
    "to_datetime",
    "view_rows",
    "weighted_count",
    "whole_number_text",
]
