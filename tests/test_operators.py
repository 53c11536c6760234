from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import functions as X
from tripmill import operators as op
from tripmill.schemas import FHV_SOURCES, NORMAL_TRIPS, TRIP_MESSAGE

# ---- projections -------------------------------------------------------------------------------


def test_normalize_by_kind(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 10:00:00' lpep_pickup_datetime, 7L PULocationID, "
        "9.5 fare_amount, 'x' other"
    )
    green = op.normalize_trips(df, "green")
    assert green.schema.simpleString() == NORMAL_TRIPS.simpleString()
    assert tuple(green.first()) == (datetime(2024, 1, 1, 10), None, 7, None, 9.5, "green", None)


def test_unknown_kind_has_the_yellow_time_columns(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01' tpep_pickup_datetime, 2 payment_type")
    row = op.normalize_trips(df, "blue").first()
    assert (row.pickup_datetime, row.taxi_type, row.payment_type) == (datetime(2024, 1, 1), "blue", 2)


def test_stage_drops_rows_without_base_and_casts(spark):
    raw = spark.createDataFrame(
        [("B1", "2019-01-01 00:00:00", None, "5", None, None, "B1"),
         (None, "2019-01-01 00:00:00", None, "5", None, None, "B2")],
        ", ".join(f"{name.upper()} string" for name in FHV_SOURCES.values()),
    )
    out = op.stage(raw)
    assert [r.pickup_location_id for r in out.collect()] == [5]
    assert out.columns == list(FHV_SOURCES)


def test_stage_strict_or_lenient(spark):
    raw = spark.createDataFrame([("a", "x")], "k string, n string")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    assert op.stage(raw, schema, {}, ["k"], strict=False).first().n is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        op.stage(raw, schema, {}, ["k"]).collect()


def test_coerce_then_drop_then_fill(spark, rows):
    raw = spark.createDataFrame(
        [("2009-06-01 01:02:03", 1.0, "2"), ("bad", 2.0, "3"), ("2009-06-02", float("nan"), "1"),
         ("2009-06-03", 5.0, "1d"), (None, 1.0, "1")],
        "t string, total double, tip string",
    )
    out = op.coerce(raw, ["t"], ["total", "tip"], ["t", "total"], ["tip"])
    assert rows(out) == [(datetime(2009, 6, 1, 1, 2, 3), 1.0, 2.0), (datetime(2009, 6, 3), 5.0, 0.0)]


MESSAGE = dict(
    times=["lpep_pickup_datetime", "lpep_dropoff_datetime"],
    ints=["PULocationID", "DOLocationID", "passenger_count"],
    doubles=["trip_distance", "tip_amount", "total_amount"],
    zero_if_null=["passenger_count"],
)


def _trips(spark):
    at = datetime(2025, 10, 1, 8, 0, 0, 999_999)
    return spark.createDataFrame(
        [(at, at, 1, 2, None, 1.0, 0.5, 9.0), (at, at, 1, 2, float("nan"), 1.0, None, 9.0),
         (None, at, 1, 2, 1.0, 1.0, 0.5, 9.0), (at, at, None, 2, 1.0, 1.0, 0.5, 9.0),
         (at, at, 1, 2, 1e12, 1.0, 0.5, 9.0), (at, at, 1, 2, 3.9, 1.0, 0.5, 9.0)],
        "lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, PULocationID long, "
        "DOLocationID long, passenger_count double, trip_distance double, tip_amount double, "
        "total_amount double",
    )


def test_messages(spark):
    trips = _trips(spark)
    back = op.from_message(op.to_message(trips, **MESSAGE), TRIP_MESSAGE).collect()
    assert [r.passenger_count for r in back] == [0, 0, 3]
    assert [r.tip_amount for r in back] == [0.5, None, 0.5]
    assert {r.lpep_pickup_datetime for r in back} == {"2025-10-01 08:00:00"}
    assert op.unsendable(trips, **MESSAGE).count() == 3


def test_sample_only_if_large(spark):
    df = spark.range(10_000)
    assert op.sample(df, 1.0, 1).count() == 10_000
    assert 800 < op.sample(df, 0.1, 1).count() < 1_200
    assert op.sample(df.limit(0), 0.1, 1).count() == 0


def test_union_fills_missing_columns(spark, rows):
    a = spark.sql("SELECT 1 x, 'a' y")
    b = spark.sql("SELECT 'b' y, 2.5D z")
    assert rows(op.union_trips(a, b)) == [(1, "a", None), (None, "b", 2.5)]


# ---- joins -------------------------------------------------------------------------------------


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(
        [("1", "North"), ("2", "South"), ("N/A", "Nowhere"), ("3", "South")], "LocationID string, Zone string"
    )


def test_zone_join_keeps_unmatched_and_survives_bad_keys(spark, zones, rows):
    trips = spark.createDataFrame([(10, 1), (11, 9), (12, None), (13, 2)], "id int, pu int")
    assert rows(op.with_zone(trips, zones, "pu")) == [
        (10, 1, "North"), (11, 9, None), (12, None, None), (13, 2, "South")
    ]


def test_zone_counts_equal_join_then_count(spark, zones, rows):
    trips = spark.createDataFrame([(k,) for k in [1] * 50 + [2] * 3 + [3] * 2 + [8] + [None] * 4], "pu int")
    twice = zones.union(zones.filter("LocationID = '2'"))  # a key may stand in the lookup twice
    joined = op.group_count(op.with_zone(trips, twice, "pu"), ["Zone"], "trips")
    assert rows(op.count_by_zone(trips, twice, "pu")) == rows(joined)
    assert ("North", 50) in rows(joined) and (None, 5) in rows(joined) and ("South", 8) in rows(joined)


def test_zone_counts_when_key_and_name_differ_only_in_case(spark, zones, rows):
    trips = spark.createDataFrame([(1,), (1,), (3,)], "zone int")
    assert rows(op.count_by_zone(trips, zones, "zone")) == [("North", 2), ("South", 1)]


def test_payment_names(spark, rows):
    trips = spark.createDataFrame([(1,), (6,), (9,), (None,)], "payment_type int")
    assert rows(op.with_payment_name(trips, "payment_type")) == [
        (1, "Credit card"), (6, "Voided"), (9, None), (None, None)
    ]


# ---- aggregates --------------------------------------------------------------------------------


def test_counts(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, 9.0), (None, float("nan"))], "k int, v double")
    assert op.total_rows(df).first()[0] == 4
    assert op.distinct_count(df, "k").first()[0] == 2
    assert op.distinct_count(df, "k", where=F.col("v") < 5).first()[0] == 1
    assert tuple(op.counts_where(df, X.greater_than("v", 5.0)).first()) == (4, 1)
    assert op.group_count(df, ["k"]).count() == 3


def test_approximate_distinct(spark):
    found = op.distinct_count(spark.range(50_000), "id", approx=True).first()[0]
    assert abs(found - 50_000) < 5_000


def test_percent_of_empty_frame_is_null(spark):
    df = spark.createDataFrame([("a",), ("CREDIT x",), (None,), ("b",)], "p string")
    assert op.percent_where(df, X.contains_text("p", "credit")).first()[0] == 25.0
    assert op.percent_where(df.limit(0), X.contains_text("p", "credit")).first()[0] is None


def test_payment_mix(spark):
    df = spark.createDataFrame([("Cash",)] * 3 + [("Other",)] + [("Credit",)] * 4, "payment_method string")
    got = [tuple(r) for r in op.payment_mix(df).collect()]
    assert got == [("Credit", 4, 0.5), ("Cash", 3, 0.375), ("Other", 1, 0.125)]


def test_daily_rollup_percent_is_zero_without_positive_total(spark):
    df = spark.createDataFrame(
        [(datetime(2009, 6, 2, 23), -5.0, 1.0), (datetime(2009, 6, 1, 1), 10.0, 2.0),
         (datetime(2009, 6, 1, 2), 30.0, 2.0)],
        "pickup_dt timestamp_ntz, total_amt double, tip_amt double",
    )
    assert [tuple(r) for r in op.daily_rollup(df).collect()] == [
        (date(2009, 6, 1), 40.0, 4.0, 2, 2.0, 10.0), (date(2009, 6, 2), -5.0, 1.0, 1, 1.0, 0.0)
    ]


def test_monthly_revenue_paths_agree(spark, zones, rows):
    trips = spark.createDataFrame(
        [(1, datetime(2020, 1, 5), "Green", 5.0), (1, datetime(2020, 1, 31, 23), "Green", 7.0),
         (2, datetime(2020, 2, 1), "Green", 1.0), (3, datetime(2020, 2, 9), "Green", 2.0),
         (2, datetime(2020, 2, 1), "Yellow", 4.0), (77, datetime(2020, 2, 1), "Yellow", 8.0)],
        "pu int, at timestamp_ntz, kind string, amount double",
    )
    fast = op.monthly_zone_revenue(trips, zones, "pu", "at", "kind", "amount")
    plain = op.monthly_revenue(op.with_zone(trips, zones, "pu"), "Zone", "at", "kind", "amount")
    assert rows(fast) == rows(plain)
    assert ("South", date(2020, 2, 1), "Green", 3.0, 2) in rows(fast)


# ---- windows and ranking -----------------------------------------------------------------------


def test_moving_average_counts_rows_not_days(spark):
    days = [date(2009, 6, 1) + timedelta(days=3 * i) for i in range(9)]
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "trip_date date, v double")
    got = [r.ma for r in op.moving_average(df, "trip_date", {"ma": "v"}).orderBy("trip_date").collect()]
    want = [sum(range(max(0, i - 6), i + 1)) / min(i + 1, 7) for i in range(9)]
    assert got == pytest.approx(want)
    with pytest.raises(TypeError):
        op.moving_average(spark.range(3), "id", {"ma": "id"})


def test_moving_average_refuses_rows_that_are_not_rolled_up(spark):
    raw = spark.range(100).select(F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 9).cast("int")).alias("d"), "id")
    with pytest.raises(Exception, match="roll up per day"):
        op.moving_average(raw, "d", {"ma": "id"}).collect()


def test_dedup_is_deterministic(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 2), (1, "c", 1), (2, "z", 5), (None, "q", 1), (None, "p", 1)],
        "k int, v string, at int",
    )
    want = [(1, "c", 1), (2, "z", 5), (None, "p", 1)]
    assert rows(op.dedup(df, ["k"], ["at"])) == want
    assert rows(op.dedup(df.orderBy(F.desc("v")).repartition(5), ["k"], ["at"])) == want


def test_ranking_breaks_ties(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), (None, 1), ("c", 1), ("d", None)], "z string, n int")
    assert [r.z for r in op.top_n(df, "n", 2, ["z"]).collect()] == ["a", "b"]
    assert [r.z for r in op.bottom_n(df, "n", 2, ["z"]).collect()] == ["c", None]
    assert op.bottom_n(df, "n", 5, ["z"]).collect()[-1].z == "d"


# ---- checks ------------------------------------------------------------------------------------

RULES = [
    op.not_null("k"), op.positive("v"), op.accepted_values("v", [1, 2]), op.unique("k"),
    op.unique("k", "v"),
]


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 0), (None, 6), (2, None), (1, 1)], "k int, v int")
    assert rows(op.check(df, RULES)) == [
        ("accepted_values", "v", 2, "fail"), ("not_null", "k", 2, "fail"), ("positive", "v", 1, "fail"),
        ("unique", "k", 2, "fail"), ("unique", "k,v", 1, "fail"),
    ]
    with pytest.raises(op.QualityError, match="accepted_values"):
        op.check(df, RULES, enforce=True)
    good = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    assert {r.status for r in op.check(good, RULES, enforce=True).collect()} == {"pass"}
    assert {r.failing_rows for r in op.check(good.limit(0), RULES).collect()} == {0}
    assert op.check(df, []).count() == 0


@pytest.mark.parametrize(
    "as_of, status",
    [("2024-01-02 00:00:00", "pass"), ("2024-01-02 00:00:00.5", "warn"), ("2024-01-03 00:00:00", "warn"),
     ("2024-01-03 00:00:00.000001", "error")],
)
def test_freshness(spark, as_of, status):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' t UNION ALL SELECT NULL")
    assert op.freshness(df, "t", as_of).first().status == status
    assert op.freshness(df.filter("t IS NULL"), "t", as_of).first().status == "error"


def test_schema_check(spark, rows):
    df = spark.sql("SELECT 1 a, 'x' b, 2 extra")
    want = T.StructType(
        [T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.DateType())]
    )
    assert {(r.column, r.status) for r in op.check_schema(df, want).collect()} == {
        ("a", "type"), ("b", "pass"), ("c", "missing"), ("extra", "surplus")
    }
    with pytest.raises(op.QualityError):
        op.check_schema(df, want, enforce=True)


def test_a_fractional_key_finds_no_zone(spark):
    zones = spark.createDataFrame([(1, "One")], "LocationID int, Zone string")
    for kind in ("double", "decimal(5,2)", "string"):
        trips = spark.createDataFrame([("1.9",), ("1",), ("1.0",), (None,), ("x",)], "k string").select(
            F.expr(f"try_cast(k as {kind})").alias("k"))
        found = op.with_zone(trips, zones, "k").filter("Zone is not null").count()
        assert found == 2, kind
