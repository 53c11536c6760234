"""Counts, filters, projections, roll-ups and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import functions as X
from tripmill import operators as op
from tripmill.plans.registry import query, table
from tripmill.schemas import FHV_STAGED, MESSAGE_FIELDS, TRIP_MESSAGE

# ---- counts and filters ------------------------------------------------------------------------


@query("SELECT count(*) AS total_rows FROM lineitem")
def total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.total_rows(table(spark, sf_dir, "lineitem"))


@query("SELECT count(DISTINCT l_suppkey) AS distinct_values FROM lineitem")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_count(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query("SELECT count(*) AS matching_rows FROM lineitem WHERE l_discount = 0")
def zero_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.count_where(table(spark, sf_dir, "lineitem"), X.equals("l_discount", 0.0))


@query(
    "SELECT count(DISTINCT user_id) AS distinct_values FROM events "
    "WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-15'"
)
def distinct_in_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = X.in_interval("ts", "2024-01-05", "2024-01-15")
    return op.distinct_count(table(spark, sf_dir, "events"), "user_id", where=inside)


@query("SELECT count(*) AS matching_rows FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def day_trip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.count_where(table(spark, sf_dir, "events"), X.on_day("ts", "2024-01-15"))


@query(
    "SELECT max(date_diff('second', o_orderdate, l_shipdate) / 3600.0)::DOUBLE AS longest_hours "
    "FROM orders JOIN lineitem ON l_orderkey = o_orderkey"
)
def longest_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the last dropoff of an order can be its longest trip, so the large side is cut down first."""
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    last = (
        table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"])
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("l_shipdate"))
    )
    trips = orders.join(last, orders["o_orderkey"] == last["l_orderkey"])
    timed = op.with_duration(trips, "o_orderdate", "l_shipdate")
    return op.maximum(timed, "duration_hours", "longest_hours")


@query("SELECT min(ts) AS first_value, max(ts) AS last_value FROM events")
def time_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.extent(table(spark, sf_dir, "events"), "ts")


@query("SELECT count(*) AS total_rows, count(*) FILTER (value > 100) AS matching_rows FROM events")
def distance_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.counts_where(table(spark, sf_dir, "events"), X.greater_than("value", 100.0))


@query("SELECT count(*) AS trips_with_tip FROM lineitem WHERE l_discount > 0")
def tipped_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    tipped = X.greater_than("l_discount", 0.0)
    return op.count_where(table(spark, sf_dir, "lineitem"), tipped, "trips_with_tip")


@query(
    "SELECT round(sum(CASE WHEN event_type ILIKE '%click%' THEN 1 ELSE 0 END) * 100.0 / count(*), 6)"
    "::DOUBLE AS credit_card_ratio FROM events"
)
def payment_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    credit = X.contains_text("event_type", "CLICK")
    ratio = op.percent_where(table(spark, sf_dir, "events"), credit, "credit_card_ratio")
    return ratio.select(F.round("credit_card_ratio", 6).alias("credit_card_ratio"))


@query("SELECT round(sum(value), 2) AS total_tips FROM events")
def total_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    tips = op.total(table(spark, sf_dir, "events"), "value", "total_tips")
    return tips.select(F.round("total_tips", 2).alias("total_tips"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def grouped_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.group_count(table(spark, sf_dir, "events"), ["event_type"])


@query(
    "SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem "
    "WHERE l_returnflag = 'R' AND year(l_shipdate) = 1998 GROUP BY l_suppkey"
)
def grouped_sum_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").filter(
        X.equals("l_returnflag", "R") & X.in_year("l_shipdate", 1998)
    )
    sums = op.group_sum(rows, ["l_suppkey"], "l_extendedprice")
    return sums.withColumn("total", F.round("total", 2))


# ---- projections -------------------------------------------------------------------------------


@query("SELECT l_partkey, l_suppkey FROM lineitem")
def two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey"])


@query("SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 5")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", ["event_id", "ts", "value"])
    return op.preview(events, 5, ["ts", "event_id"])


@query(
    "SELECT o_orderpriority AS dispatching_base_num, o_orderdate AS pickup_datetime, "
    "CAST(NULL AS TIMESTAMP) AS dropoff_datetime, "
    "CAST(o_custkey % 265 AS INTEGER) AS pickup_location_id, "
    "CAST(o_orderkey % 265 AS INTEGER) AS dropoff_location_id, "
    "o_orderstatus AS sr_flag, CAST(o_totalprice::DECIMAL(12, 2) AS VARCHAR) AS affiliated_base_number "
    "FROM orders WHERE o_orderstatus <> 'P'"
)
def staging_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of status P stand for trips without a dispatching base."""
    raw = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("Dispatching_base_num"),
        F.col("o_orderdate").cast("string").alias("pickup_datetime"),
        F.lit(None).cast("string").alias("dropOff_datetime"),
        (F.col("o_custkey") % 265).cast("string").alias("PUlocationID"),
        (F.col("o_orderkey") % 265).cast("string").alias("DOlocationID"),
        F.col("o_orderstatus").alias("SR_Flag"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("Affiliated_base_number"),
    )
    return op.stage(raw, FHV_STAGED)


@query(
    "SELECT o_orderdate AS pickup_datetime, CAST(NULL AS TIMESTAMP) AS dropoff_datetime, "
    "CAST(o_custkey % 265 AS INTEGER) AS pickup_location_id, CAST(NULL AS INTEGER) AS dropoff_location_id, "
    "o_totalprice AS fare_amount, CASE WHEN o_orderstatus = 'F' THEN 'green' ELSE 'yellow' END "
    "AS taxi_type, CAST(left(o_orderpriority, 1) AS INTEGER) AS payment_type FROM orders"
)
def trips_unioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds with different raw names; neither has all columns."""
    orders = table(spark, sf_dir, "orders")
    code = F.left("o_orderpriority", F.lit(1)).cast("bigint").alias("payment_type")
    fare = F.col("o_totalprice").alias("fare_amount")
    zone = (F.col("o_custkey") % 265).alias("PULocationID")
    green = orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderdate").alias("lpep_pickup_datetime"), zone, fare, code
    )
    yellow = orders.filter("o_orderstatus <> 'F'").select(
        zone, code, F.col("o_orderdate").alias("tpep_pickup_datetime"), fare
    )
    return op.union_trips(
        op.normalize_trips(green, "green"), op.normalize_trips(yellow, "yellow")
    )


@query(
    "SELECT event_id, ts AS pickup_dt, CASE WHEN event_type IN ('click', 'error') THEN value END "
    "AS total_amt, CASE WHEN event_type = 'click' THEN value ELSE 0 END AS tip_amt "
    "FROM events WHERE event_type IN ('click', 'error')"
)
def coerced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text with values and times that do not parse."""
    value = F.col("value").cast("string")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "signup", "no time").otherwise(F.col("ts").cast("string"))
        .alias("pickup_dt"),
        F.when(F.col("event_type").isin("view", "purchase"), F.concat(value, F.lit("d")))
        .otherwise(F.concat(F.lit(" "), value)).alias("total_amt"),
        F.when(F.col("event_type") == "click", value).otherwise("n/a").alias("tip_amt"),
    )
    return op.coerce(
        raw,
        times=["pickup_dt"],
        numbers=["total_amt", "tip_amt"],
        drop_null_in=["pickup_dt", "total_amt"],
        fill_zero=["tip_amt"],
    )


def _message_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    signup = F.col("event_type") == "signup"
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("lpep_pickup_datetime"),
        F.when(F.col("event_type") != "error", F.col("ts")).alias("lpep_dropoff_datetime"),
        (F.col("user_id") % 265).alias("PULocationID"),
        (F.col("event_id") % 265).alias("DOLocationID"),
        F.when(~signup, F.lit(2.0)).alias("passenger_count"),
        F.col("value").alias("trip_distance"),
        F.when(~signup, F.col("value")).alias("tip_amount"),
        F.col("value").alias("total_amount"),
    )


@query(
    "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS lpep_pickup_datetime, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS lpep_dropoff_datetime, "
    'CAST(user_id % 265 AS INTEGER) AS "PULocationID", '
    'CAST(event_id % 265 AS INTEGER) AS "DOLocationID", '
    "CASE WHEN event_type = 'signup' THEN 0 ELSE 2 END AS passenger_count, value AS trip_distance, "
    "CASE WHEN event_type <> 'signup' THEN value END AS tip_amount, value AS total_amount "
    "FROM events WHERE event_type <> 'error'"
)
def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to JSON messages and back; rows without a dropoff time cannot be sent."""
    messages = op.to_message(_message_source(spark, sf_dir), **MESSAGE_FIELDS)
    return op.from_message(messages, TRIP_MESSAGE)


@query(
    "SELECT count(*) FILTER (event_type <> 'error') AS sent, "
    "count(*) FILTER (event_type = 'error') AS skipped FROM events"
)
def message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _message_source(spark, sf_dir)
    sent = op.to_message(source, **MESSAGE_FIELDS).select(F.lit(1).alias("sent"))
    skipped = op.unsendable(source, **MESSAGE_FIELDS).select(F.lit(1).alias("skipped"))
    both = op.union_trips(sent, skipped)
    return both.agg(F.count("sent").alias("sent"), F.count("skipped").alias("skipped"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sample_small_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fraction of 1 keeps all rows."""
    customers = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal"])
    return op.sample(customers, 1.0, seed=7)


# ---- payment methods ---------------------------------------------------------------------------

# Spellings spread over the events, so that every rule of the normaliser is met.
SPELLINGS = [
    "Credit", " CARD ", "cash card", "Cash", "1", "2.9", "1e0", "3", "1d", "nan", "", "no charge"
]
_SPELLED = (
    "SELECT event_id, ["
    + ", ".join(f"'{s}'" for s in SPELLINGS)
    + f"][event_id % {len(SPELLINGS)} + 1] AS payment_raw FROM events"
)
_METHOD = (
    "CASE WHEN lower(trim(payment_raw)) LIKE '%credit%' OR lower(trim(payment_raw)) LIKE '%card%' "
    "THEN 'Credit' WHEN lower(payment_raw) LIKE '%cash%' THEN 'Cash' "
    "WHEN NOT regexp_full_match(payment_raw, '[0-9]+([.][0-9]*)?(e[0-9]+)?') THEN 'Other' "
    "WHEN trunc(TRY_CAST(payment_raw AS DOUBLE)) = 1 THEN 'Credit' "
    "WHEN trunc(TRY_CAST(payment_raw AS DOUBLE)) = 2 THEN 'Cash' ELSE 'Other' END"
)


def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelling = F.element_at(
        F.array(*[F.lit(s) for s in SPELLINGS]), (F.col("event_id") % len(SPELLINGS) + 1).cast("int")
    )
    return table(spark, sf_dir, "events", ["event_id"]).withColumn("payment_raw", spelling)


@query(f"SELECT event_id, payment_raw, {_METHOD} AS payment_method FROM ({_SPELLED})")
def payment_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spelled(spark, sf_dir).withColumn("payment_method", X.payment_method("payment_raw"))


@query(
    f"SELECT payment_method, count(*) AS trips, round(count(*) / sum(count(*)) OVER (), 6) AS pct "
    f"FROM (SELECT {_METHOD} AS payment_method FROM ({_SPELLED})) GROUP BY payment_method"
)
def payment_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spelled(spark, sf_dir).select(X.payment_method("payment_raw").alias("payment_method"))
    return op.payment_mix(rows).withColumn("pct", F.round("pct", 6))


@query(
    "SELECT lang, CASE WHEN lower(text) LIKE '%credit%' OR lower(text) LIKE '%card%' THEN 'Credit' "
    "WHEN lower(text) LIKE '%cash%' THEN 'Cash' ELSE 'Other' END AS payment_method, "
    "count(*) AS n FROM documents GROUP BY ALL"
)
def payment_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normaliser on free text of any length."""
    texts = table(spark, sf_dir, "documents", ["lang", "text"])
    return op.group_count(
        texts.select("lang", X.payment_method("text").alias("payment_method")),
        ["lang", "payment_method"],
    )


@query(
    "SELECT CASE l_linenumber WHEN 1 THEN 'Credit' WHEN 2 THEN 'Cash' ELSE 'Other' END "
    "AS payment_method, count(*) AS n FROM lineitem GROUP BY ALL"
)
def payment_from_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "lineitem", ["l_linenumber"])
    return op.group_count(
        codes.select(X.payment_method("l_linenumber").alias("payment_method")), ["payment_method"]
    )


# ---- roll-ups ----------------------------------------------------------------------------------

_DAYS = (
    "SELECT CAST(ts AS DATE) AS trip_date, sum(value) AS total_amt, "
    "sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS tip_amt, "
    "count(*) AS trip_count FROM events GROUP BY 1"
)
_DAY_COLUMNS = (
    "trip_date, round(total_amt, 2) AS total_amt, round(tip_amt, 2) AS tip_amt, trip_count, "
    "round(tip_amt / trip_count, 4) AS avg_tip_per_trip, "
    "round(CASE WHEN total_amt > 0 THEN tip_amt / total_amt * 100 ELSE 0 END, 4) AS tip_percentage"
)


def _paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", ["ts", "event_type", "value"]).select(
        F.col("ts").alias("pickup_dt"),
        F.col("value").alias("total_amt"),
        F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0).alias("tip_amt"),
    )


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


_DAY_DIGITS = {"total_amt": 2, "tip_amt": 2, "avg_tip_per_trip": 4, "tip_percentage": 4}


@query(f"SELECT {_DAY_COLUMNS} FROM ({_DAYS})")
def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.daily_rollup(_paid(spark, sf_dir)), _DAY_DIGITS)


@query(
    f"SELECT {_DAY_COLUMNS}, round(avg(total_amt) OVER seven, 4) AS revenue_ma7, "
    f"round(avg(tip_amt) OVER seven, 4) AS tips_ma7 FROM ({_DAYS}) "
    "WINDOW seven AS (ORDER BY trip_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
)
def daily_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = op.daily_rollup(_paid(spark, sf_dir), ordered=False)
    means = {"revenue_ma7": "total_amt", "tips_ma7": "tip_amt"}
    out = op.moving_average(daily, "trip_date", means)
    return _rounded(out, {**_DAY_DIGITS, "revenue_ma7": 4, "tips_ma7": 4})


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate "
    "FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, "
    "l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1"
)
def staging_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice", "l_shipdate"]
    return op.dedup(
        table(spark, sf_dir, "lineitem", columns), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


# ---- checks ------------------------------------------------------------------------------------


@query(
    """
    WITH found AS (
      SELECT 'not_null' AS "check", 'l_shipdate' AS "column",
             count(*) FILTER (l_shipdate IS NULL) AS failing_rows FROM lineitem
      UNION ALL
      SELECT 'positive', 'l_discount', count(*) FILTER (NOT l_discount > 0) FROM lineitem
      UNION ALL
      SELECT 'accepted_values', 'l_linenumber',
             count(*) FILTER (l_linenumber NOT IN (1, 2, 3, 4, 5, 6)) FROM lineitem
      UNION ALL
      SELECT 'unique', 'l_orderkey,l_linenumber',
             CAST(sum(n - 1) AS BIGINT)
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    )
    SELECT *, CASE WHEN failing_rows > 0 THEN 'fail' ELSE 'pass' END AS status FROM found
    """
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.check(
        table(spark, sf_dir, "lineitem"),
        [
            op.not_null("l_shipdate"),
            op.positive("l_discount"),
            op.accepted_values("l_linenumber", [1, 2, 3, 4, 5, 6]),
            op.unique("l_orderkey", "l_linenumber"),
        ],
    )


@query(
    "SELECT newest, age_seconds, CASE WHEN age > INTERVAL 48 HOUR THEN 'error' "
    "WHEN age > INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS status FROM (SELECT max(ts) AS newest, "
    "TIMESTAMP '2024-02-01 00:00:00' - max(ts) AS age, "
    "date_sub('second', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS age_seconds FROM events)"
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.freshness(table(spark, sf_dir, "events"), "ts", "2024-02-01 00:00:00")
