"""Declared sources and writes behind their checks, on the events and orders as raw trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import operators as op
from tripmill import sinks
from tripmill.declared import FHV, GREEN, YELLOW, Source, report_all
from tripmill.plans.registry import query, table
from tripmill.session import shared_dir

_AS_OF = "2024-02-01 00:00:00"
# How each declared column with a rule is made of an event, in either dialect: codes run one beyond the list, and some are NULL.
_MADE = {
    "vendorid": "CASE WHEN event_id % 10 <> 0 THEN 1 + event_id % 3 END",
    "ratecodeid": "1 + event_id % 7",
    "store_and_fwd_flag": "CASE event_id % 5 WHEN 0 THEN 'Y' WHEN 1 THEN '?' WHEN 2 THEN 'N' END",
    "payment_type": "1 + event_id % 6",
    "trip_type": "1 + event_id % 4",
    "dispatching_base_num": "CASE WHEN event_id % 8 <> 0 THEN 'B1' END",
}
# The newest pickup of each source is so many days after that of the events, which makes one of each state.
_DAYS = {"green_tripdata": 0, "yellow_tripdata": 1, "fhv_tripdata": -3}


def _as_source(events: DataFrame, source: Source) -> DataFrame:
    def column(f: T.StructField) -> Column:
        if f.name == source.loaded_at:
            made = F.col("ts") + F.make_dt_interval(days=F.lit(_DAYS[source.name]))
        elif f.name.lower() in _MADE:
            made = F.expr(_MADE[f.name.lower()])
        else:
            made = F.lit(None)
        return made.cast(f.dataType).alias(f.name)

    return events.select(*[column(f) for f in source.schema.fields])


def _report_sql() -> str:
    rows = []

    def row(source: Source, check: str, column: str, failing: str, status: str | None = None) -> None:
        status = status or "CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END"
        rows.append(
            f"SELECT '{source.name}' AS source, '{check}' AS \"check\", '{column}' AS \"column\", "
            f"n::BIGINT AS failing_rows, {status} AS status FROM ({failing})")

    for s in (GREEN, YELLOW, FHV):
        for f in s.schema.fields:
            row(s, "schema", f.name, "SELECT 0 AS n")
        for c in s.required:
            row(s, "not_null", c, f"SELECT count(*) AS n FROM events WHERE ({_MADE[c.lower()]}) IS NULL")
        for c, codes in s.codes.items():
            listed = ", ".join(repr(code) for code in codes)
            row(s, "accepted_values", c, f"SELECT count(*) AS n FROM events WHERE ({_MADE[c.lower()]}) NOT IN ({listed})")
        age = (f"SELECT TIMESTAMP '{_AS_OF}' - (max(ts) + INTERVAL ({_DAYS[s.name]}) DAY) AS age, "
               "CASE WHEN age > INTERVAL 24 HOUR THEN 1 ELSE 0 END AS n FROM events")
        row(s, "freshness", s.loaded_at, age,
            "CASE WHEN age > INTERVAL 48 HOUR THEN 'error' WHEN age > INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END")
    return " UNION ALL ".join(rows)


@query(_report_sql())
def source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three declared sources with missing and unknown codes, one of them fresh, one late, one too old."""
    events = table(spark, sf_dir, "events", ["event_id", "ts"])
    tables = {s.name: _as_source(events, s) for s in (GREEN, YELLOW, FHV)}
    return report_all(tables, _AS_OF)


@query(
    "SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total, "
    "(SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS refused_rows FROM orders "
    "WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus"
)
def checked_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes that pass their checks; between them one of all orders, with a status that is not declared."""
    path = shared_dir(spark, "checked")
    orders = table(spark, sf_dir, "orders")
    rules = [op.not_null("o_orderkey"), op.positive("o_totalprice"), op.accepted_values("o_orderstatus", ["F", "O"]),
             op.unique("o_orderkey")]
    sinks.write_checked(orders.filter("o_orderstatus = 'F'"), path, rules)
    refused = "0"
    try:
        sinks.write_checked(orders, path, rules)
    except op.QualityError as error:
        refused = str(error).removeprefix("accepted_values(o_orderstatus): ")
    sinks.write_checked(orders.filter("o_orderstatus = 'O'"), path, rules)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"),
    ).withColumn("refused_rows", F.lit(int(refused)).cast("bigint"))


_DECLARED = "o_orderkey bigint, o_custkey int, o_comment string, o_totalprice double, o_orderdate timestamp_ntz"


@query(
    "WITH declared AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{c.split()[0]}', '{c.split()[1]}')" for c in _DECLARED.split(", "))
    + ") v(name, kind)), found AS (SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'bigint' "
    "WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS kind "
    "FROM (DESCRIBE SELECT * FROM orders)) "
    "SELECT coalesce(d.name, f.name) AS \"column\", d.kind AS declared, f.kind AS found, CASE WHEN f.kind IS NULL THEN 'missing' "
    "WHEN d.kind IS NULL THEN 'surplus' WHEN d.kind <> f.kind THEN 'type' ELSE 'pass' END AS status "
    "FROM declared d FULL JOIN found f ON d.name = f.name"
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declaration with a column too many, some too few, and one of another type."""
    return op.check_schema(table(spark, sf_dir, "orders"), T.StructType.fromDDL(_DECLARED))


@query(
    "SELECT c_custkey, c_name FROM customer "
    "WHERE ('0x' || substr(md5(c_custkey::VARCHAR || '/7'), 1, 8))::BIGINT < 0.25 * 4294967296"
)
def sample_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the customers, the same ones in every run."""
    customers = table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return op.sample_by_key(customers.repartition(3), ["c_custkey"], 0.25, seed=7)


@query("SELECT 4::BIGINT AS files, true AS sizes_fit, count(*) AS total_rows FROM lineitem")
def file_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of four files against the sizes that their own rows report."""
    path = shared_dir(spark, "four")
    sinks.write_n_files(table(spark, sf_dir, "lineitem"), path, 4)
    rows = spark.read.parquet(path).groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    told = rows.agg(F.sum("size").alias("sum"), F.avg(F.col("size") / (1024 * 1024)).alias("avg"), F.sum("n").alias("total_rows"))
    stats = sinks.file_stats(spark, path)
    return stats.join(told, (F.col("bytes") == F.col("sum")), "left").select(
        "files", F.coalesce(F.col("avg_mb") == F.round("avg", 1), F.lit(False)).alias("sizes_fit"), "total_rows")
