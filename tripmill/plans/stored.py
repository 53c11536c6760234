"""Queries that write a table first and then read it back.

Every call writes the whole test table to a folder of its own below the shared folder.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import functions as X
from tripmill import operators as op
from tripmill import sinks, sources
from tripmill.plans import taxi
from tripmill.plans.registry import SCHEMAS, query, table
from tripmill.session import shared_dir
from tripmill.storage import child_names, rename

# ---- files -------------------------------------------------------------------------------------

_CSV = {"header": "true", "compression": "gzip", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def _as_csv(df: DataFrame, path: str) -> None:
    df.write.options(**_CSV).csv(path)


@query("SELECT * FROM orders")
def csv_typed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "orders-csv")
    _as_csv(table(spark, sf_dir, "orders"), path)
    return sources.read_trips_csv(spark, path, T.StructType.fromDDL(SCHEMAS["orders"]))


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"
)
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "orders-csv")
    _as_csv(table(spark, sf_dir, "orders"), path)
    found = sources.read_csv_inferred(spark, path)
    return found.select(
        F.col("o_orderkey").cast("bigint"),
        F.col("o_custkey").cast("bigint"),
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("timestamp_ntz"),
    )


@query(
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, "
    "CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS c_mktsegment FROM customer"
)
def union_by_name_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two folders differ in column order, and one lacks a column."""
    path = shared_dir(spark, "customers")
    customers = table(spark, sf_dir, "customer")
    customers.filter("c_acctbal < 0").write.parquet(f"{path}/a")
    customers.filter("c_acctbal >= 0").select(
        "c_acctbal", "c_nationkey", "c_name", "c_custkey"
    ).write.parquet(f"{path}/b")
    return sources.read_union_by_name(spark, [f"{path}/a", f"{path}/b"]).select(
        *customers.columns
    )


@query(
    "SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority "
    "FROM orders"
)
def union_by_name_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder with an append of narrow keys and one of wide keys, which alone has a third column."""
    path = shared_dir(spark, "orders")
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    narrow = orders.filter("o_custkey % 2 = 0").drop("o_orderpriority")
    narrow.withColumn("o_custkey", F.col("o_custkey").cast("int")).write.parquet(path)
    wide = orders.filter("o_custkey % 2 = 1").withColumn("o_custkey", F.col("o_custkey").cast("long"))
    wide.write.mode("append").parquet(path)
    return sources.read_union_by_name(spark, path).select(*orders.columns)


@query(
    "SELECT CAST(l_suppkey AS INTEGER) AS l_suppkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, "
    "l_shipdate, CAST(l_quantity AS FLOAT) AS l_quantity FROM lineitem"
)
def typed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrower table, filled by an append."""
    path = shared_dir(spark, "narrow")
    narrow = T.StructType(
        [
            T.StructField("l_suppkey", T.IntegerType()),
            T.StructField("l_linenumber", T.ShortType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
            T.StructField("l_quantity", T.FloatType()),
        ]
    )
    loaded = sources.load_typed(table(spark, sf_dir, "lineitem"), narrow)
    op.check_schema(loaded, narrow, enforce=True)
    sinks.materialize(loaded, path, "append")
    return spark.read.parquet(path)


_PRICED = "SELECT count(DISTINCT o_custkey) AS customers, round(sum(o_totalprice), 2) AS total FROM orders"


def _unique(name: str) -> str:
    """A catalog name of this call alone, so that queries may run side by side."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _priced(df: DataFrame) -> DataFrame:
    return df.agg(
        F.countDistinct("o_custkey").alias("customers"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@query(_PRICED)
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _priced(
        sources.register_external(spark, _unique("orders_external"), f"{sf_dir}/orders.parquet")
    )


@query(_PRICED)
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created twice; the second run replaces the first."""
    orders = table(spark, sf_dir, "orders")
    where, name = shared_dir(spark, "warehouse"), _unique("orders_loaded")
    sinks.replace_table(orders.filter("o_orderstatus = 'F'"), name, where)
    return _priced(sinks.replace_table(orders, name, where))


@query("SELECT 4::BIGINT AS files, count(*) AS total_rows FROM lineitem")
def n_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "four")
    sinks.write_n_files(table(spark, sf_dir, "lineitem"), path, 4)
    stats = sinks.file_stats(spark, path).select("files")
    return stats.withColumn("total_rows", op.total_rows(spark.read.parquet(path)).scalar())


@query("SELECT count(*) AS total_rows, 0::BIGINT AS oversized_files FROM lineitem")
def chunked_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of at most 5,000 rows."""
    path = shared_dir(spark, "chunks")
    sinks.write_chunks(table(spark, sf_dir, "lineitem"), path, 5_000)
    per_file = (
        spark.read.parquet(path).groupBy("_metadata.file_name").agg(F.count(F.lit(1)).alias("n"))
    )
    return per_file.agg(
        F.sum("n").alias("total_rows"), F.count_if(F.col("n") > 5_000).alias("oversized_files")
    )


@query(
    "SELECT count(DISTINCT l_suppkey) AS distinct_values FROM lineitem "
    "WHERE l_shipdate BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-15'"
)
def partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by month of the ship date; the query opens one month's folder."""
    path = shared_dir(spark, "layout")
    lines = table(spark, sf_dir, "lineitem")
    sinks.write_layout(lines, path, "l_shipdate", ["l_suppkey", "l_shipdate"])
    inside = X.between_months("l_shipdate", "1998-03-01", "1998-03-15")
    return op.distinct_count(spark.read.parquet(path), "l_suppkey", where=inside)


@query("SELECT * FROM customer")
def run_day_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run day's output, written twice."""
    root = shared_dir(spark, "days")
    customers = table(spark, sf_dir, "customer")
    sinks.write_day(customers, root, 7)
    return spark.read.parquet(sinks.write_day(customers, root, 7))


# ---- months ------------------------------------------------------------------------------------

_MONTH_TEXT = "date_format(o_orderdate, 'yyyy-MM')"


def _land_months(df: DataFrame, root: str, name: str, fmt: str) -> None:
    """One file name per month, by one job and a rename of each folder."""
    named = df.withColumn("name", F.expr(name))
    writer = named.hint("rebalance", "name").write.partitionBy("name")
    if fmt == "csv":
        writer.options(**_CSV).csv(root)
    else:
        writer.parquet(root)
    for child in child_names(df.sparkSession, root):
        rename(df.sparkSession, f"{root}/{child}", f"{root}/{child.removeprefix('name=')}")


@query(
    "SELECT o_orderdate AS pickup_datetime, CAST(NULL AS TIMESTAMP) AS dropoff_datetime, "
    "CAST(o_custkey % 265 AS INTEGER) AS pickup_location_id, CAST(NULL AS INTEGER) AS dropoff_location_id, "
    "o_totalprice AS fare_amount, CASE WHEN o_orderstatus = 'F' THEN 'green' ELSE 'yellow' END "
    "AS taxi_type, CAST(NULL AS INTEGER) AS payment_type FROM orders "
    "WHERE date_trunc('month', o_orderdate) <> DATE '1996-05-01'"
)
def month_range_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months of two kinds; the files of May 1996 were never landed."""
    root = shared_dir(spark, "months")
    orders = table(spark, sf_dir, "orders").filter(f"{_MONTH_TEXT} <> '1996-05'")
    kind = F.when(F.col("o_orderstatus") == "F", "green").otherwise("yellow")
    trips = orders.select(
        F.col("o_orderdate"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        (F.col("o_custkey") % 265).alias("PULocationID"),
        F.col("o_totalprice").alias("fare_amount"),
        kind.alias("kind"),
    )
    _land_months(trips, root, f"concat(kind, '_tripdata_', {_MONTH_TEXT}, '.parquet')", "parquet")
    columns = {"tpep_pickup_datetime": "pickup_datetime", "PULocationID": "pickup_location_id"}
    return sources.ingest_months(
        spark,
        root,
        "1995-01-15",
        "2001-12-10",
        ["green", "yellow"],
        renames={"green": columns, "yellow": columns},
    )


@query("SELECT o_orderkey, o_totalprice, o_orderdate, year(o_orderdate)::INTEGER * 100 + "
       "month(o_orderdate)::INTEGER AS year_month FROM orders")
def converted_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip CSV months to Parquet in two runs; the second converts only what the first did not."""
    landed, target = shared_dir(spark, "csv-months"), shared_dir(spark, "parquet-months")
    schema = T.StructType.fromDDL("o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz")
    orders = table(spark, sf_dir, "orders", schema.names)
    _land_months(orders, landed, f"concat('fhv_tripdata_', {_MONTH_TEXT}, '.csv.gz')", "csv")
    months = sources.months_between("1995-01-01", "2001-12-31")
    sinks.convert_months(spark, landed, target, "fhv", months[:40], schema)
    sinks.convert_months(spark, landed, target, "fhv", months, schema)
    return spark.read.parquet(target)


# ---- landed pages and snapshots ----------------------------------------------------------------

_PAGE_ROWS = 500


@query(
    f"SELECT event_id, user_id, value, (event_id // {_PAGE_ROWS} + CASE WHEN event_id // {_PAGE_ROWS} < "
    f"(SELECT (max(event_id) // {_PAGE_ROWS} + 1) // 2 FROM events) THEN 1 ELSE 2 END)::INTEGER AS page FROM events"
)
def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 500 rows, the page in the middle empty; all rows are read."""
    root = shared_dir(spark, "pages")
    events = table(spark, sf_dir, "events", ["event_id", "user_id", "value"])
    full = F.floor(F.col("event_id") / _PAGE_ROWS)
    half = events.agg(F.floor((F.floor(F.max("event_id") / _PAGE_ROWS) + 1) / 2)).scalar()
    page = F.when(full < half, full + 1).otherwise(full + 2).cast("int")
    pages = (
        events.select(page.alias("page"), F.to_json(F.struct(*events.columns)).alias("row"))
        .groupBy("page")
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("row"), ","), F.lit("]")).alias("value"))
    )
    empty = spark.range(1).select((half + 1).cast("int").alias("page"), F.lit("[]").alias("value"))
    pages.union(empty).write.partitionBy("page").text(root)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    return sources.read_json_pages(spark, root, schema)


@query("SELECT * FROM orders")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots; the newest lacks the table, so the one before it counts."""
    root = shared_dir(spark, "snapshots")
    orders = table(spark, sf_dir, "orders")
    filled = orders.filter("o_orderstatus = 'F'")
    sinks.write_snapshot(filled, root, "orders", at=datetime(2024, 1, 1))
    sinks.write_snapshot(orders, root, "orders", at=datetime(2024, 1, 2))
    sinks.write_snapshot(table(spark, sf_dir, "nation"), root, "nation", at=datetime(2024, 1, 3))
    return sources.read_latest_snapshot(spark, root, "orders")


@query(
    "SELECT trip_date, round(total_amt, 2) AS total_amt, round(tip_amt, 2) AS tip_amt, trip_count, "
    "round(avg(total_amt) OVER seven, 4) AS revenue_ma7, round(avg(tip_amt) OVER seven, 4) AS tips_ma7 "
    "FROM (SELECT CAST(ts AS DATE) AS trip_date, sum(value) AS total_amt, "
    "sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS tip_amt, count(*) AS trip_count "
    "FROM events WHERE event_type NOT IN ('signup', 'error') GROUP BY 1) "
    "WINDOW seven AS (ORDER BY trip_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
)
def payment_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the newest snapshot of raw text to days with moving averages."""
    daily = taxi.payment_overview(_payments(spark, sf_dir)).daily.select(
        "trip_date", "total_amt", "tip_amt", "trip_count", "revenue_ma7", "tips_ma7"
    )
    digits = {"total_amt": 2, "tip_amt": 2, "revenue_ma7": 4, "tips_ma7": 4}
    return daily.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "payments")
    kind, value = F.col("event_type"), F.col("value").cast("string")
    raw = table(spark, sf_dir, "events").select(
        F.when(kind == "signup", "soon").otherwise(F.col("ts").cast("string"))
        .alias("trip_pickup_date_time"),
        kind.alias("payment_type"),
        F.when(kind == "error", "?").otherwise(value).alias("total_amt"),
        F.when(kind == "click", value).otherwise("none").alias("tip_amt"),
    )
    sinks.write_snapshot(raw, root, "taxi_data", "taxi")
    return taxi.load_payments(spark, root)


@query(
    'SELECT count(*) AS "rows", min(ts) AS first_pickup, max(ts) AS last_pickup, '
    "round(sum(value) FILTER (event_type = 'click'), 2) AS total_tips, "
    "count(*) FILTER (event_type = 'click' AND value > 0) AS trips_with_tips "
    "FROM events WHERE event_type NOT IN ('signup', 'error')"
)
def payment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals beside the days of ``payment_overview``."""
    summary = taxi.payment_overview(_payments(spark, sf_dir)).summary
    return summary.withColumn("total_tips", F.round("total_tips", 2))


# ---- write strategies --------------------------------------------------------------------------


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders")
def append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "append")
    orders = table(spark, sf_dir, "orders")
    sinks.materialize(orders, path, "append", key="o_orderdate")
    sinks.materialize(orders, path, "append", key="o_orderdate")
    return sinks.read_months(spark, path)


@query("SELECT * FROM orders")
def replace_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "replace")
    orders = table(spark, sf_dir, "orders")
    sinks.materialize(orders, path, "replace", key="o_orderdate")
    sinks.materialize(orders, path, "replace", key="o_orderdate")
    return sinks.read_months(spark, path)


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def view_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = table(spark, sf_dir, "orders").filter(X.equals("o_orderstatus", "F"))
    name = _unique("filled_orders")
    sinks.materialize(filled, name, "view")
    return spark.table(name)


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderdate >= '1996-03-10' AND "
    "o_orderdate < '1997-02-06' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
    "o_orderdate, o_orderpriority FROM orders WHERE NOT (o_orderdate >= '1996-03-10' AND "
    "o_orderdate < '1997-02-06' AND month(o_orderdate) = 7)"
)
def time_interval_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interval with ragged edges is corrected twice; the correction has no rows in July."""
    path = shared_dir(spark, "interval")
    orders = table(spark, sf_dir, "orders")
    sinks.materialize(orders, path, "replace", key="o_orderdate")
    inside = F.col("o_orderdate").between("1996-03-10", "1997-02-05 23:59:59.999999")
    corrected = orders.filter(inside & (F.month("o_orderdate") != 7)).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    for _ in range(2):
        sinks.materialize(
            corrected, path, "time_interval", "o_orderdate", "1996-03-10", "1997-02-05"
        )
    return sinks.read_months(spark, path)
