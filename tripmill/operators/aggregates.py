"""Aggregations. Each is a partial aggregate in the scanning tasks and a merge after one shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import calendar_day, month_start
from tripmill.operators.joins import with_zone
from tripmill.operators.windows import share_of_total


def total_rows(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_count(
    df: DataFrame,
    c: str,
    where: Column | None = None,
    approx: bool = False,
    name: str = "distinct_values",
) -> DataFrame:
    """Number of different non-NULL values; ``approx`` trades about 2 % error for a fixed-size sketch."""
    rows = df if where is None else df.filter(where)
    return rows.agg((F.approx_count_distinct(c, 0.02) if approx else F.countDistinct(c)).alias(name))


def count_where(df: DataFrame, cond: Column, name: str = "matching_rows") -> DataFrame:
    return total_rows(df.filter(cond), name)


def counts_where(
    df: DataFrame, cond: Column, total_name: str = "total_rows", name: str = "matching_rows"
) -> DataFrame:
    """Rows and matching rows in one pass; for a stream these are running counts."""
    return df.agg(F.count(F.lit(1)).alias(total_name), F.count_if(cond).alias(name))


def extent(df: DataFrame, c: str, low: str = "first_value", high: str = "last_value") -> DataFrame:
    return df.agg(F.min(c).alias(low), F.max(c).alias(high))


def total(df: DataFrame, c: str, name: str = "total") -> DataFrame:
    return df.agg(F.sum(c).alias(name))


def maximum(df: DataFrame, c: str | Column, name: str = "maximum") -> DataFrame:
    return df.agg(F.max(c).alias(name))


def percent_where(df: DataFrame, cond: Column, name: str = "percent") -> DataFrame:
    """Share of rows that match, in percent; NULL for an empty frame."""
    hits = F.sum(F.when(cond, 1).otherwise(0)) * F.lit(100.0)
    return df.agg(F.try_divide(hits, F.count(F.lit(1))).alias(name))


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key; NULL is a key of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_sum(df: DataFrame, keys: Sequence[str], c: str, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(c).alias(name))


def payment_mix(df: DataFrame, c: str = "payment_method", name: str = "trips") -> DataFrame:
    """Trips and share of all trips per payment method, most frequent first."""
    mix = share_of_total(group_count(df, [c], name), name, "pct")
    return mix.orderBy(F.desc(name), F.asc(c))


def daily_rollup(
    df: DataFrame,
    time: str = "pickup_dt",
    total_amt: str = "total_amt",
    tip_amt: str = "tip_amt",
    day: str = "trip_date",
    ordered: bool = True,
) -> DataFrame:
    """Per day: sums, trips, tip per trip, and tips in percent of the total (0 if that is not positive).

    ``ordered=False`` leaves out the final sort by day, for steps that sort for themselves.
    """
    daily = df.groupBy(calendar_day(time).alias(day)).agg(
        F.sum(total_amt).alias("total_amt"),
        F.sum(tip_amt).alias("tip_amt"),
        F.count(F.lit(1)).alias("trip_count"),
    )
    percent = F.when(F.col("total_amt") > 0, F.col("tip_amt") / F.col("total_amt") * 100)
    out = daily.withColumns(
        {
            "avg_tip_per_trip": F.col("tip_amt") / F.col("trip_count"),
            "tip_percentage": percent.otherwise(F.lit(0.0)),
        }
    )
    return out.orderBy(day) if ordered else out


def monthly_revenue(
    df: DataFrame, zone: str, time: str, kind: str, amount: str
) -> DataFrame:
    """Revenue and trips per zone name, month and service type; all are columns of ``df``."""
    return df.groupBy(
        F.col(zone).alias("pickup_zone"),
        month_start(time).alias("revenue_month"),
        F.col(kind).alias("service_type"),
    ).agg(
        F.sum(amount).alias("revenue_monthly_total_amount"),
        F.count(F.lit(1)).alias("total_monthly_trips"),
    )


def monthly_zone_revenue(
    trips: DataFrame,
    zones: DataFrame,
    key: str,
    time: str,
    kind: str,
    amount: str,
    zone_key: str = "LocationID",
    zone_name: str = "Zone",
) -> DataFrame:
    """``monthly_revenue`` with the zone name looked up on the way.

    Trips are summed per key before the join: what is shuffled and joined is at most one row per key,
    month and type, however many trips a hot key has.
    """
    per_key = monthly_revenue(trips, key, time, kind, amount).withColumnRenamed("pickup_zone", "_key")
    named = with_zone(per_key, zones, "_key", zone_key, zone_name)
    return (
        named.groupBy(F.col(zone_name).alias("pickup_zone"), "revenue_month", "service_type")
        .agg(
            F.sum("revenue_monthly_total_amount").alias("revenue_monthly_total_amount"),
            F.sum("total_monthly_trips").alias("total_monthly_trips"),
        )
    )
