"""Column expressions shared by the operators."""

from casepulse.functions.periods import (
    first_of_month,
    month_period,
    on_or_before,
    on_or_after_year,
    period_start,
    shift_months,
    week_period,
)
from casepulse.functions.rounding import round4, scaled4

__all__ = [
    "first_of_month",
    "month_period",
    "on_or_after_year",
    "on_or_before",
    "period_start",
    "round4",
    "scaled4",
    "shift_months",
    "week_period",
]
