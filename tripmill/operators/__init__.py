"""Operators: functions from DataFrame to DataFrame with columns as parameters."""

from tripmill.operators.aggregates import (
    count_where,
    counts_where,
    daily_rollup,
    distinct_count,
    extent,
    group_count,
    group_sum,
    maximum,
    monthly_revenue,
    monthly_zone_revenue,
    payment_mix,
    percent_where,
    total,
    total_rows,
)
from tripmill.operators.joins import count_by_zone, with_payment_name, with_zone
from tripmill.operators.projections import (
    coerce,
    from_message,
    keep,
    normalize_trips,
    preview,
    sample,
    sample_by_key,
    stage,
    to_message,
    union_trips,
    unsendable,
    with_constant,
    with_duration,
)
from tripmill.operators.quality import (
    QualityError,
    accepted_values,
    check,
    check_schema,
    freshness,
    not_null,
    positive,
    unique,
)
from tripmill.operators.ranking import bottom_n, sort_by, top_n
from tripmill.operators.windows import dedup, moving_average, share_of_total

__all__ = [
    "QualityError",
    "accepted_values",
    "bottom_n",
    "check",
    "check_schema",
    "coerce",
    "count_by_zone",
    "count_where",
    "counts_where",
    "daily_rollup",
    "dedup",
    "distinct_count",
    "extent",
    "freshness",
    "from_message",
    "group_count",
    "group_sum",
    "keep",
    "maximum",
    "monthly_revenue",
    "monthly_zone_revenue",
    "moving_average",
    "normalize_trips",
    "not_null",
    "payment_mix",
    "percent_where",
    "positive",
    "preview",
    "sample",
    "sample_by_key",
    "share_of_total",
    "sort_by",
    "stage",
    "to_message",
    "top_n",
    "total",
    "total_rows",
    "union_trips",
    "unique",
    "unsendable",
    "with_constant",
    "with_duration",
    "with_payment_name",
    "with_zone",
]
