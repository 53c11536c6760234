"""The questions asked of taxi trips, in taxi columns; each is a composition of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill import functions as X
from tripmill import operators as op
from tripmill import sinks, sources
from tripmill import streaming as st
from tripmill.schemas import MESSAGE_FIELDS, TIME_COLUMNS, TRIP_MESSAGE, YELLOW_CSV, YELLOW_NARROW

# ---- month files into a relational database ----------------------------------------------------


def ingest_csv_month(
    spark: SparkSession, root: str, kind: str, year: int, month: int, url: str, table: str,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Replace a database table by one month's gzip CSV."""
    path = sources.month_path(root, kind, year, month, "csv.gz")
    trips = sources.read_trips_csv(spark, path, YELLOW_CSV, partitions=8)
    sinks.write_jdbc(trips, url, table, connections=8, properties=properties)


def ingest_parquet_month(
    spark: SparkSession, root: str, kind: str, year: int, month: int, url: str, table: str,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Replace a database table by one month's Parquet file."""
    trips = sources.read_trips(spark, sources.month_path(root, kind, year, month))
    sinks.write_jdbc(trips, url, table, connections=8, properties=properties)


def ingest_zones(
    spark: SparkSession, path: str, url: str, table: str = "taxi_zones",
    properties: Mapping[str, str] | None = None,
) -> None:
    zones = sources.read_zones(spark, path)
    sinks.write_jdbc(zones, url, table, connections=1, properties=properties)


# ---- warehouse ---------------------------------------------------------------------------------


def load_warehouse(spark: SparkSession, months: str | Sequence[str], path: str) -> DataFrame:
    """The narrow yellow table, one folder per month of dropoff, sorted by vendor and dropoff."""
    trips = sources.load_typed(sources.read_union_by_name(spark, months), YELLOW_NARROW)
    sinks.write_layout(
        trips, path, "tpep_dropoff_datetime", ["VendorID", "tpep_dropoff_datetime"]
    )
    return spark.read.parquet(path)


def pickup_locations(warehouse: DataFrame) -> DataFrame:
    return op.distinct_count(warehouse, "PULocationID", name="unique_pickup_locations")


def zero_fares(warehouse: DataFrame) -> DataFrame:
    return op.count_where(warehouse, X.equals("fare_amount", 0), "zero_fare_count")


def vendors_between(warehouse: DataFrame, low: str, high: str) -> DataFrame:
    inside = X.between_months("tpep_dropoff_datetime", low, high)
    return op.distinct_count(warehouse, "VendorID", where=inside, name="vendors")


# ---- monthly revenue model ---------------------------------------------------------------------


def revenue_rows(trips: DataFrame, kind: str) -> DataFrame:
    """What the revenue model needs of one kind of raw trips."""
    return trips.select(
        F.col(TIME_COLUMNS[kind][0]).alias("pickup_datetime"),
        F.col("PULocationID").cast("int").alias("pickup_location_id"),
        F.col("total_amount").cast("double"),
        F.lit(kind.capitalize()).alias("service_type"),
    )


def monthly_zone_revenue(green: DataFrame, yellow: DataFrame, zones: DataFrame) -> DataFrame:
    trips = op.union_trips(revenue_rows(green, "green"), revenue_rows(yellow, "yellow"))
    return op.monthly_zone_revenue(
        trips, zones, "pickup_location_id", "pickup_datetime", "service_type", "total_amount"
    )


def top_zone(model: DataFrame, service_type: str, year: int) -> DataFrame:
    rows = model.filter(X.equals("service_type", service_type) & X.in_year("revenue_month", year))
    sums = op.group_sum(rows, ["pickup_zone"], "revenue_monthly_total_amount", "total_revenue")
    return op.top_n(sums, "total_revenue", 1, ["pickup_zone"])


def trips_in_month(model: DataFrame, service_type: str, month: date | str) -> DataFrame:
    rows = model.filter(X.equals("service_type", service_type) & X.in_month("revenue_month", month))
    return op.total(rows, "total_monthly_trips", "total_trips")


# ---- batch report ------------------------------------------------------------------------------


def trips_on_day(trips: DataFrame, day: date | str) -> DataFrame:
    return op.count_where(trips, X.on_day("tpep_pickup_datetime", day), "trips")


def longest_trip_hours(trips: DataFrame) -> DataFrame:
    timed = op.with_duration(trips, "tpep_pickup_datetime", "tpep_dropoff_datetime")
    longest = op.maximum(timed, "duration_hours", "hours")
    return longest.select(F.round("hours", 1).alias("hours"))


def least_frequent_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return op.bottom_n(op.count_by_zone(trips, zones, "PULocationID"), "trips", 1, ["Zone"])


# ---- payments ----------------------------------------------------------------------------------

_NO_PAYMENTS = "pickup_dt timestamp_ntz, payment_raw string, total_amt double, tip_amt double"


class PaymentOverview(NamedTuple):
    summary: DataFrame
    mix: DataFrame
    daily: DataFrame


def load_pages(
    spark: SparkSession, pages: str, root: str, table: str = "taxi_data", name: str = "taxi"
) -> str:
    """Landed API pages into a new snapshot; returns its path."""
    rows = sources.read_json_pages(spark, pages).drop("page")
    return sinks.write_snapshot(rows, root, table, name)


def load_payments(
    spark: SparkSession, root: str, table: str = "taxi_data"
) -> DataFrame:
    """Payments of the newest snapshot that has the table; empty, with all columns, if none has."""
    try:
        raw = sources.read_latest_snapshot(spark, root, table)
    except FileNotFoundError:
        return spark.createDataFrame([], _NO_PAYMENTS)
    return payments(raw)


def payments(raw: DataFrame) -> DataFrame:
    """Four columns of the raw rows, readably typed."""
    rows = raw.select(
        F.col("trip_pickup_date_time").alias("pickup_dt"),
        F.col("payment_type").cast("string").alias("payment_raw"),
        "total_amt",
        "tip_amt",
    )
    return op.coerce(
        rows, times=["pickup_dt"], numbers=["total_amt", "tip_amt"],
        drop_null_in=["pickup_dt", "total_amt"],
    )


def payment_overview(rows: DataFrame) -> PaymentOverview:
    """Totals, mix of methods, and days with their 7-row means."""
    summary = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("pickup_dt").alias("first_pickup"),
        F.max("pickup_dt").alias("last_pickup"),
        F.sum("tip_amt").alias("total_tips"),
        F.count_if(X.greater_than("tip_amt", 0.0)).alias("trips_with_tips"),
    )
    filled = op.coerce(rows, fill_zero=["tip_amt"])
    method = filled.select(X.payment_method("payment_raw").alias("payment_method"))
    daily = op.moving_average(
        op.daily_rollup(filled, ordered=False),
        "trip_date",
        {"revenue_ma7": "total_amt", "tips_ma7": "tip_amt"},
    )
    return PaymentOverview(summary, op.payment_mix(method), op.sort_by(daily, "trip_date"))


# ---- messages and streams ----------------------------------------------------------------------

def publish_green(
    trips: DataFrame, path: str | None = None, kafka: Mapping[str, str] | None = None
) -> DataFrame:
    """Send green trips as JSON; returns the rows that could not be sent."""
    rows = trips.select(*TRIP_MESSAGE.names)
    sinks.publish_json(op.to_message(rows, **MESSAGE_FIELDS), path, kafka)
    return op.unsendable(rows, **MESSAGE_FIELDS)


def green_stream(
    spark: SparkSession, path: str | None = None, kafka: Mapping[str, str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Trip messages with event time and a watermark five seconds behind."""
    stream = st.stream_trips(spark, TRIP_MESSAGE, path=path, kafka=kafka, max_files=max_files)
    return st.with_event_time(stream, "lpep_pickup_datetime")


def count_long_trips(
    spark: SparkSession, miles: float = 5.0, path: str | None = None,
    kafka: Mapping[str, str] | None = None,
) -> DataFrame:
    """All messages there are, and those of trips longer than ``miles``."""
    messages = st.read_topic(spark, TRIP_MESSAGE, path=path, kafka=kafka)
    return op.counts_where(messages, X.greater_than("trip_distance", miles))


def run_trip_counts(
    stream: DataFrame, out: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Trips per five minutes and pickup location; key is window_start and PULocationID."""
    counts = st.tumbling(stream, "event_time", "5 minutes", ["PULocationID"])
    return st.run(counts.drop("window_end"), st.upsert_sink(out), checkpoint, every=every)


def read_trip_counts(spark: SparkSession, out: str) -> DataFrame:
    return st.read_upserted(spark, out, ["window_start", "PULocationID"])


def run_trip_sessions(
    stream: DataFrame, out: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Sessions of a pickup location, five minutes apart."""
    found = st.sessions(stream, "event_time", "5 minutes", ["PULocationID"])
    return st.run(found, st.append_sink(out), checkpoint, every=every)


def run_hourly_tips(
    stream: DataFrame, out: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    tips = st.tumbling(
        stream, "event_time", "1 hour", aggs={"total_tip_amount": ("sum", "tip_amount")}
    )
    return st.run(tips.drop("window_end"), st.append_sink(out), checkpoint, every=every)
