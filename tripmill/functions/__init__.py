"""Column expressions. All stay in the JVM; none is a Python UDF."""

from tripmill.functions.parsing import (
    number,
    payment_method,
    same_text,
    squish,
    whole_number,
)
from tripmill.functions.predicates import (
    between_months,
    contains_text,
    equals,
    greater_than,
    in_interval,
    in_month,
    in_year,
    on_day,
)
from tripmill.functions.temporal import (
    MESSAGE_TIME,
    calendar_day,
    duration_hours,
    message_time,
    month_start,
    parse_time,
    year_month,
)

__all__ = [
    "MESSAGE_TIME",
    "between_months",
    "calendar_day",
    "contains_text",
    "duration_hours",
    "equals",
    "greater_than",
    "in_interval",
    "in_month",
    "in_year",
    "message_time",
    "month_start",
    "number",
    "on_day",
    "parse_time",
    "payment_method",
    "same_text",
    "squish",
    "whole_number",
    "year_month",
]
