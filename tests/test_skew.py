"""A third of all rows under one key, with thresholds scaled down so that small data shows the plan."""

import pytest
from pyspark.sql import functions as F

from tripmill import operators as op
from tripmill import sinks

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def scaled_down(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture
def trips(spark, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 997).cast("int"))
    spark.range(0, 300_000, 1, 8).select(
        hot.alias("pu"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("note")
    ).write.parquet(f"{tmp_path}/trips")
    return spark.read.parquet(f"{tmp_path}/trips")


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_zone_join_splits_the_hot_partition(scaled_down, trips):
    zones = scaled_down.range(1, 900).select(
        F.col("id").alias("LocationID"), F.concat(F.lit("zone "), "id").alias("Zone")
    )
    joined = op.with_zone(trips, zones, "pu").agg(
        F.count("Zone").alias("named"), F.countDistinct("note").alias("rows")
    )
    got = joined.collect()[0]
    assert got.rows == 300_000
    assert got.named == trips.filter("pu between 1 and 899").count()
    assert "skew=true" in _final_plan(joined)


def test_counts_ship_one_row_per_key_and_task(scaled_down, trips):
    zones = scaled_down.range(1, 900).select(F.col("id").alias("LocationID"), F.lit("z").alias("Zone"))
    counted = op.count_by_zone(trips, zones, "pu")
    assert sum(r.trips for r in counted.collect()) == 300_000
    assert "skew" not in _final_plan(counted)


def test_a_hot_month_becomes_several_files(scaled_down, trips, tmp_path):
    path = f"{tmp_path}/layout"
    at = F.when(F.col("pu") == 1, F.lit("2024-05-05")).otherwise(F.lit("2024-06-06"))
    sinks.write_layout(trips.withColumn("t", at.cast("timestamp_ntz")), path, "t", ["pu"])
    files = scaled_down.read.parquet(path).groupBy("year_month").agg(
        F.countDistinct("_metadata.file_name").alias("files"), F.count("*").alias("n")
    )
    got = {r.year_month: (r.files, r.n) for r in files.collect()}
    assert got[202405][0] > 1 and got[202405][1] + got[202406][1] == 300_000


def test_copies_of_one_row_are_cut_before_the_shuffle(spark, trips):
    copies = trips.select(F.when(F.col("pu") == 1, 0).otherwise(F.col("id")).alias("k"), "pu")
    kept = op.dedup(copies, ["k"])
    assert kept.count() == copies.select("k").distinct().count()
    assert "row_number(), 1, Partial" in _final_plan(kept)
