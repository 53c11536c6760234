"""Zone and payment lookups and the monthly revenue model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import functions as X
from tripmill import operators as op
from tripmill.plans.registry import query, table
from tripmill.session import shared_dir
from tripmill.sources import read_zones

# Quantities run to 50 and nation keys to 24, so half of the line items have no zone.


@query(
    "SELECT p_partkey, p_size, n_name FROM part LEFT JOIN nation ON p_size = n_nationkey"
)
def trips_with_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part", ["p_partkey", "p_size"])
    return op.with_zone(parts, table(spark, sf_dir, "nation"), "p_size", "n_nationkey", "n_name")


_ZONE_COUNTS = (
    "SELECT n_name, count(*) AS trips FROM lineitem "
    "LEFT JOIN nation ON CAST(l_quantity AS BIGINT) = n_nationkey GROUP BY n_name"
)


def _zone_counts(spark: SparkSession, sf_dir: str, zones: DataFrame) -> DataFrame:
    trips = table(spark, sf_dir, "lineitem", ["l_quantity"])
    return op.count_by_zone(trips, zones, "l_quantity", "n_nationkey", "n_name")


@query(_ZONE_COUNTS)
def zone_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone_counts(spark, sf_dir, table(spark, sf_dir, "nation"))


@query(f"SELECT * FROM ({_ZONE_COUNTS}) ORDER BY trips, n_name NULLS LAST LIMIT 1")
def least_frequent_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup is a CSV read as text, one of its keys not a number."""
    path = shared_dir(spark, "zones")
    key = F.when(F.col("n_name") != "NATION_0", F.col("n_nationkey").cast("string")).otherwise("N/A")
    zones = table(spark, sf_dir, "nation").withColumn("n_nationkey", key)
    zones.write.csv(path, header=True)
    counts = _zone_counts(spark, sf_dir, read_zones(spark, path, raw=True))
    return op.bottom_n(counts, "trips", 1, ["n_name"])


@query(
    "SELECT r_name AS borough, count(*) AS trips FROM lineitem "
    "LEFT JOIN nation ON CAST(l_quantity AS BIGINT) = n_nationkey "
    "LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY ALL"
)
def borough_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup is a CSV with declared types."""
    path = shared_dir(spark, "zones")
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Zone").alias("service_zone"),
    ).write.csv(path, header=True)
    trips = table(spark, sf_dir, "lineitem", ["l_quantity"])
    counts = op.count_by_zone(trips, read_zones(spark, path), "l_quantity", zone_name="Borough")
    return counts.withColumnRenamed("Borough", "borough")


@query(
    "SELECT CASE l_linenumber WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' "
    "WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided' END AS payment_name, "
    "count(*) AS n FROM lineitem GROUP BY ALL"
)
def payment_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted per code first; the lookup then sees one row per code."""
    codes = op.group_count(table(spark, sf_dir, "lineitem"), ["l_linenumber"])
    named = op.with_payment_name(codes, "l_linenumber")
    return named.groupBy("payment_name").agg(F.sum("n").alias("n"))


# ---- monthly revenue ---------------------------------------------------------------------------

# The stand-in for a zone: 25 numbers, of which 20 are in the lookup, so that some trips have none.
_REVENUE = (
    "SELECT n_name AS pickup_zone, CAST(date_trunc('month', o_orderdate) AS DATE) AS revenue_month, "
    "o_orderpriority AS service_type, sum(o_totalprice) AS revenue_monthly_total_amount, "
    "count(*) AS total_monthly_trips FROM orders "
    "LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON n_nationkey = o_custkey % 25 GROUP BY ALL"
)


def _revenue(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """The model; ``where`` is a condition on the trips, which reaches their scan."""
    orders = table(spark, sf_dir, "orders")
    trips = orders if where is None else orders.filter(where)
    return op.monthly_zone_revenue(
        trips.withColumn("zone_id", F.col("o_custkey") % 25),
        table(spark, sf_dir, "nation").filter("n_nationkey < 20"),
        key="zone_id",
        time="o_orderdate",
        kind="o_orderpriority",
        amount="o_totalprice",
        zone_key="n_nationkey",
        zone_name="n_name",
    )


@query(
    "SELECT pickup_zone, revenue_month, service_type, round(revenue_monthly_total_amount, 2) AS "
    f"revenue_monthly_total_amount, total_monthly_trips FROM ({_REVENUE})"
)
def monthly_zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = "revenue_monthly_total_amount"
    return _revenue(spark, sf_dir).withColumn(amount, F.round(amount, 2))


@query(
    "SELECT pickup_zone, round(sum(revenue_monthly_total_amount), 2) AS total_revenue "
    f"FROM ({_REVENUE}) WHERE service_type = '1-URGENT' AND extract(year FROM revenue_month) = 1998 "
    "GROUP BY pickup_zone ORDER BY sum(revenue_monthly_total_amount) DESC, pickup_zone LIMIT 1"
)
def top_zone_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = X.equals("o_orderpriority", "1-URGENT") & X.in_year("o_orderdate", 1998)
    sums = op.group_sum(
        _revenue(spark, sf_dir, urgent),
        ["pickup_zone"],
        "revenue_monthly_total_amount",
        "total_revenue",
    )
    best = op.top_n(sums, "total_revenue", 1, ["pickup_zone"])
    return best.withColumn("total_revenue", F.round("total_revenue", 2))


@query(
    f"SELECT CAST(sum(total_monthly_trips) AS BIGINT) AS total_trips FROM ({_REVENUE}) "
    "WHERE service_type = '1-URGENT' AND revenue_month = '1998-10-01'"
)
def month_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = X.equals("o_orderpriority", "1-URGENT") & X.in_month("o_orderdate", "1998-10-01")
    rows = _revenue(spark, sf_dir, month)
    return op.total(rows, "total_monthly_trips", "total_trips")


@query("SELECT count(*) AS total_rows FROM (" + _REVENUE + ")")
def monthly_revenue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.total_rows(_revenue(spark, sf_dir))
