from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import operators as op
from tripmill.declared import FHV, GREEN, SOURCES, YELLOW, Source, report_all

SMALL = Source(
    "small", T.StructType().add("id", "long").add("code", "integer").add("at", "timestamp_ntz"), codes={"code": (1, 2)}, required=("id",), keys=("id",),
    loaded_at="at", warn_after=timedelta(hours=1), error_after=timedelta(hours=2),
)


def _report(df, as_of=None):
    return {(r.check, r.column): (r.failing_rows, r.status) for r in SMALL.report(df, as_of).collect()}


def test_report_of_a_declared_source(spark):
    at = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(1, 1, at), (1, None, at), (None, 7, at)], SMALL.schema)
    assert _report(df, "2024-01-01 13:30:00") == {
        ("schema", "id"): (0, "pass"), ("schema", "code"): (0, "pass"), ("schema", "at"): (0, "pass"),
        ("not_null", "id"): (1, "fail"), ("accepted_values", "code"): (1, "fail"), ("unique", "id"): (1, "fail"),
        ("freshness", "at"): (1, "warn")}
    states = [_report(df, f"2024-01-01 {t}")["freshness", "at"] for t in ("12:30:00", "13:30:00", "15:00:00")]
    assert states == [(0, "pass"), (1, "warn"), (1, "error")]
    assert ("freshness", "at") not in _report(df)
    empty = _report(df.limit(0), "2024-01-01 13:30:00")
    assert empty["not_null", "id"] == (0, "pass") and empty["freshness", "at"] == (1, "error")
    assert SMALL.staged(df).count() == 2


def test_rules_of_columns_that_are_not_there_are_left_to_the_schema(spark):
    df = spark.range(2).withColumn("code", F.lit("x")).withColumn("more", F.lit(1))
    got = _report(df.withColumn("code", F.lit(1)), "2024-01-01")
    assert got["schema", "at"] == (1, "fail") and got["schema", "more"] == (0, "warn")
    assert ("freshness", "at") not in got and got["not_null", "id"] == (0, "pass")


def test_declarations():
    assert set(SOURCES) == {"green_tripdata", "yellow_tripdata", "fhv_tripdata"}
    assert [r.check for r in GREEN.rules()].count("accepted_values") == 5 and len(YELLOW.rules()) == 5 and len(FHV.rules()) == 1
    with pytest.raises(ValueError, match="speed"):
        Source("s", GREEN.schema, codes={"speed": (1,)})


def test_read_and_report_all(spark, tmp_path):
    spark.createDataFrame([(None,) * 19], GREEN.schema).write.parquet(str(tmp_path / "g"))
    df = GREEN.read(spark, str(tmp_path / "g"))
    whole = report_all({"green_tripdata": df, "yellow_tripdata": spark.createDataFrame([], YELLOW.schema)}, "2024-01-01")
    failing = {(r.source, r.check) for r in whole.filter("status = 'fail'").collect()}
    assert failing == {("green_tripdata", "not_null")}
    assert whole.filter("check = 'freshness' AND status = 'error'").count() == 2


def test_sample_by_key(spark):
    df = spark.range(20_000).withColumn("k", F.col("id") % 4_000)
    few = op.sample_by_key(df, ["k"], 0.1, 1)
    keys = {r.k for r in few.select("k").distinct().collect()}
    assert 300 < len(keys) < 500 and few.count() == 5 * len(keys)
    assert {r.k for r in op.sample_by_key(df.repartition(7), ["k"], 0.1, 1).collect()} == keys
    assert keys < {r.k for r in op.sample_by_key(df, ["k"], 0.2, 1).collect()}
    assert keys != {r.k for r in op.sample_by_key(df, ["k"], 0.1, 2).collect()}
    assert op.sample_by_key(df, ["k"], 1.0, 1).count() == 20_000 and op.sample_by_key(df, ["k"], 0.0, 1).count() == 0
