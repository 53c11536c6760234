import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripmill import operators as op
from tripmill import streaming as st
from tripmill.plans import taxi


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(
        [("74", "East Harlem North"), ("75", "East Harlem South"), ("105", "Liberty Island")],
        "LocationID string, Zone string",
    )


def _yellow(spark, *trips):
    return spark.createDataFrame(
        [(1, datetime.fromisoformat(a), datetime.fromisoformat(b), 1, 2.5, pu, 2, fare, fare + 1.0)
         for a, b, pu, fare in trips],
        "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count long, trip_distance double, PULocationID long, DOLocationID long, "
        "fare_amount double, total_amount double",
    )


TRIPS = [
    ("2024-03-01 00:10:00", "2024-03-01 00:40:00", 74, 0.0),
    ("2024-03-14 23:00:00", "2024-03-15 00:00:01", 74, 9.0),
    ("2024-03-15 09:00:00", "2024-03-18 12:06:00", 105, 7.0),
    ("2024-04-02 09:00:00", "2024-04-02 09:10:00", 75, 7.0),
    ("2024-04-02 10:00:00", "2024-04-02 10:10:00", 75, 7.0),
]


def test_warehouse(spark, tmp_path):
    _yellow(spark, *TRIPS[:3]).write.parquet(f"{tmp_path}/m/yellow_tripdata_2024-03.parquet")
    _yellow(spark, *TRIPS[3:]).write.parquet(f"{tmp_path}/m/yellow_tripdata_2024-04.parquet")
    table = taxi.load_warehouse(spark, f"{tmp_path}/m/*", f"{tmp_path}/w")
    assert op.total_rows(table).first()[0] == 5
    assert taxi.pickup_locations(table).first()[0] == 3
    assert taxi.zero_fares(table).first()[0] == 1
    assert taxi.vendors_between(table, "2024-03-01", "2024-03-15").first()[0] == 1
    assert table.schema["fare_amount"].dataType.simpleString() == "float"


def test_batch_report(spark, zones):
    trips = _yellow(spark, *TRIPS)
    assert taxi.trips_on_day(trips, "2024-03-15").first()[0] == 1
    assert taxi.longest_trip_hours(trips).first()[0] == 75.1
    assert tuple(taxi.least_frequent_zone(trips, zones).first()) == ("Liberty Island", 1)


def test_revenue_model(spark, zones):
    yellow = _yellow(spark, *TRIPS)
    green = yellow.withColumnsRenamed(
        {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
    ).filter("PULocationID <> 105")
    model = taxi.monthly_zone_revenue(green, yellow, zones)
    assert model.count() == 5
    assert tuple(taxi.top_zone(model, "Green", 2024).first()) == ("East Harlem South", 16.0)
    assert taxi.trips_in_month(model, "Green", "2024-03-01").first()[0] == 2
    assert model.filter("pickup_zone = 'Liberty Island'").first().revenue_month == date(2024, 3, 1)


def test_payments(spark, tmp_path):
    assert taxi.load_payments(spark, f"{tmp_path}/store").count() == 0
    raw = (
        [("2009-06-01 10:00:00", "Credit", "10.0", "2"), ("2009-06-01 11:00:00", "CASH ", "10.0", None),
         ("2009-06-03 10:00:00", "1", "20.0", "x"), ("bad", "Cash", "9", "1"), ("2009-06-03", "Cash", "?", "1")]
    )
    names = ("trip_pickup_date_time", "payment_type", "total_amt", "tip_amt")
    for number, part in enumerate([raw[:2], [], raw[2:]], 1):  # the second page is empty
        (tmp_path / f"pages/page={number}").mkdir(parents=True)
        text = json.dumps([dict(zip(names, row)) for row in part])
        (tmp_path / f"pages/page={number}/data.json").write_text(text)
    taxi.load_pages(spark, f"{tmp_path}/pages", f"{tmp_path}/store")
    rows = taxi.load_payments(spark, f"{tmp_path}/store")
    summary, mix, daily = taxi.payment_overview(rows)
    assert tuple(summary.first()) == (3, datetime(2009, 6, 1, 10), datetime(2009, 6, 3, 10), 2.0, 1)
    assert [(r.payment_method, r.trips) for r in mix.collect()] == [("Credit", 2), ("Cash", 1)]
    assert [tuple(r) for r in daily.collect()] == [
        (date(2009, 6, 1), 20.0, 2.0, 2, 1.0, 10.0, 20.0, 2.0),
        (date(2009, 6, 3), 20.0, 0.0, 1, 0.0, 0.0, 20.0, 1.0),
    ]


def test_streams(spark, tmp_path):
    start = datetime(2025, 10, 16, 18)
    offsets = [0, 60, 120, 500, 3_000, 7_300]
    trips = spark.createDataFrame(
        [(s, 74 if s < 3_000 else 75) for s in offsets], "s int, PULocationID int"
    ).select(
        (F.lit(start) + F.make_dt_interval(secs="s")).cast("timestamp_ntz").alias("lpep_pickup_datetime"),
        F.lit(start).cast("timestamp_ntz").alias("lpep_dropoff_datetime"),
        "PULocationID",
        F.lit(1).alias("DOLocationID"),
        F.lit(None).cast("double").alias("passenger_count"),
        (F.col("s") / 100).alias("trip_distance"),
        F.lit(1.5).alias("tip_amount"),
        F.lit(9.0).alias("total_amount"),
    )
    topic = f"{tmp_path}/topic"
    unsent = taxi.publish_green(trips.union(trips.limit(1).withColumn("PULocationID", F.lit(None))), topic)
    assert unsent.count() == 1
    assert tuple(taxi.count_long_trips(spark, path=topic).first()) == (6, 2)
    for name, job in [("counts", taxi.run_trip_counts), ("sessions", taxi.run_trip_sessions),
                      ("tips", taxi.run_hourly_tips)]:
        job(taxi.green_stream(spark, path=topic), f"{tmp_path}/{name}", f"{tmp_path}/cp-{name}")
    counts = taxi.read_trip_counts(spark, f"{tmp_path}/counts")
    best = op.top_n(counts, "num_trips", 1, ["window_start", "PULocationID"]).first()
    assert (best.window_start, best.PULocationID, best.num_trips) == (start, 74, 3)
    sessions = st.read_appended(spark, f"{tmp_path}/sessions")
    assert sorted((r.PULocationID, r.num_trips) for r in sessions.collect()) == [(74, 1), (74, 3), (75, 1)]
    tips = st.read_appended(spark, f"{tmp_path}/tips").orderBy("window_start").collect()
    assert [(r.window_start, r.total_tip_amount) for r in tips] == [(start, 7.5)]
