"""Declared schemas and code lists of trip records."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, SHORT = T.LongType(), T.IntegerType(), T.ShortType()
DOUBLE, FLOAT, TEXT, TIME = T.DoubleType(), T.FloatType(), T.StringType(), T.TimestampNTZType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Column names and types of the published trip files.
YELLOW_CSV = _struct(
    ("VendorID", LONG),
    ("tpep_pickup_datetime", TIME),
    ("tpep_dropoff_datetime", TIME),
    ("passenger_count", LONG),
    ("trip_distance", DOUBLE),
    ("RatecodeID", LONG),
    ("store_and_fwd_flag", TEXT),
    ("PULocationID", LONG),
    ("DOLocationID", LONG),
    ("payment_type", LONG),
    ("fare_amount", DOUBLE),
    ("extra", DOUBLE),
    ("mta_tax", DOUBLE),
    ("tip_amount", DOUBLE),
    ("tolls_amount", DOUBLE),
    ("improvement_surcharge", DOUBLE),
    ("total_amount", DOUBLE),
    ("congestion_surcharge", DOUBLE),
)

# The narrow warehouse table. Spark has no unsigned types, so each is widened by one step.
YELLOW_NARROW = _struct(
    ("VendorID", SHORT),
    ("tpep_pickup_datetime", TIME),
    ("tpep_dropoff_datetime", TIME),
    ("passenger_count", SHORT),
    ("trip_distance", FLOAT),
    ("PULocationID", INT),
    ("DOLocationID", INT),
    ("fare_amount", FLOAT),
)

GREEN_RAW = _struct(
    ("vendorid", LONG),
    ("lpep_pickup_datetime", TIME),
    ("lpep_dropoff_datetime", TIME),
    ("passenger_count", LONG),
    ("trip_distance", DOUBLE),
    ("pulocationid", LONG),
    ("dolocationid", LONG),
    ("ratecodeid", LONG),
    ("store_and_fwd_flag", TEXT),
    ("payment_type", LONG),
    ("fare_amount", DOUBLE),
    ("extra", DOUBLE),
    ("mta_tax", DOUBLE),
    ("tip_amount", DOUBLE),
    ("tolls_amount", DOUBLE),
    ("improvement_surcharge", DOUBLE),
    ("total_amount", DOUBLE),
    ("trip_type", LONG),
    ("ehail_fee", DOUBLE),
)

FHV_STAGED = _struct(
    ("dispatching_base_num", TEXT),
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("pickup_location_id", INT),
    ("dropoff_location_id", INT),
    ("sr_flag", TEXT),
    ("affiliated_base_number", TEXT),
)

# Staged name -> raw name of for-hire trips.
FHV_SOURCES = {
    "dispatching_base_num": "dispatching_base_num",
    "pickup_datetime": "pickup_datetime",
    "dropoff_datetime": "dropOff_datetime",
    "pickup_location_id": "PUlocationID",
    "dropoff_location_id": "DOlocationID",
    "sr_flag": "SR_Flag",
    "affiliated_base_number": "Affiliated_base_number",
}

NORMAL_TRIPS = _struct(
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("pickup_location_id", INT),
    ("dropoff_location_id", INT),
    ("fare_amount", DOUBLE),
    ("taxi_type", TEXT),
    ("payment_type", INT),
)

# Pickup and dropoff time columns by kind of taxi; other kinds use the yellow pair.
TIME_COLUMNS = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
}

ZONES = _struct(("LocationID", INT), ("Borough", TEXT), ("Zone", TEXT), ("service_zone", TEXT))

TRIP_MESSAGE = _struct(
    ("lpep_pickup_datetime", TEXT),
    ("lpep_dropoff_datetime", TEXT),
    ("PULocationID", INT),
    ("DOLocationID", INT),
    ("passenger_count", INT),
    ("trip_distance", DOUBLE),
    ("tip_amount", DOUBLE),
    ("total_amount", DOUBLE),
)

# How the columns of a trip message are written.
MESSAGE_FIELDS = {
    "times": ["lpep_pickup_datetime", "lpep_dropoff_datetime"],
    "ints": ["PULocationID", "DOLocationID", "passenger_count"],
    "doubles": ["trip_distance", "tip_amount", "total_amount"],
    "zero_if_null": ["passenger_count"],
}

# Code lists of the source description.
VENDOR_CODES = (1, 2)
RATE_CODES = (1, 2, 3, 4, 5, 6)
PAYMENT_CODES = (1, 2, 3, 4, 5, 6)
TRIP_TYPE_CODES = (1, 2)
FLAG_CODES = ("Y", "N")
PAYMENT_NAMES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}
