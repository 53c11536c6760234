import gzip
import json
import os
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from tripmill import sources
from tripmill.schemas import NORMAL_TRIPS, YELLOW_CSV
from tripmill.sources import files

# ---- CSV ---------------------------------------------------------------------------------------


def _csv(path, lines):
    with gzip.open(path, "wt") as f:
        f.write("\n".join([",".join(YELLOW_CSV.names), *lines]) + "\n")
    return str(path)


GOOD = "1,2021-01-01 00:30:10,2021-01-01 00:36:12,1,2.10,1,N,142,43,2,8,3,0.5,0,0,0.3,11.8,2.5"
BLANK = ",2021-01-01 00:30:10,2021-01-01 00:36:12,,2.10,,,142.0,43,,8,3,0.5,0,0,0.3,11.8,"


def test_typed_csv(spark, tmp_path):
    path = _csv(tmp_path / "t.csv.gz", [GOOD, BLANK])
    df = sources.read_trips_csv(spark, path, partitions=3)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in YELLOW_CSV]
    assert df.rdd.getNumPartitions() == 3
    got = {r.VendorID: r for r in df.collect()}
    assert got[1].tpep_pickup_datetime == datetime(2021, 1, 1, 0, 30, 10)
    assert (got[None].passenger_count, got[None].PULocationID, got[None].store_and_fwd_flag) == (None, 142, None)


def test_typed_csv_strict_and_lenient(spark, tmp_path):
    path = _csv(tmp_path / "t.csv.gz", [GOOD.replace("1,", "one,", 1)])
    assert sources.read_trips_csv(spark, path, strict=False).first().VendorID is None
    with pytest.raises(Exception):
        sources.read_trips_csv(spark, path).collect()


def test_typed_csv_goes_by_header_names(spark, tmp_path):
    (tmp_path / "a").mkdir()
    path = tmp_path / "a" / "1.csv"
    path.write_text("tip_amount,unknown,vendorid\n1.5,x,2.0\n")
    row = sources.read_trips_csv(spark, str(path)).first()
    assert (row.VendorID, row.tip_amount, row.trip_distance) == (2, 1.5, None)
    (tmp_path / "a" / "2.csv").write_text("vendorid,tip_amount,unknown\n2,1.5,x\n")
    for read in (sources.read_trips_csv, sources.read_csv_inferred):
        with pytest.raises(Exception, match="CSV header"):
            read(spark, str(tmp_path / "a")).collect()


def test_zones(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n')
    assert sources.read_zones(spark, str(path)).first().LocationID == 1
    raw = sources.read_zones(spark, str(path), raw=True)
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    assert sources.read_csv_inferred(spark, str(path)).schema["LocationID"].dataType == T.IntegerType()


# ---- Parquet -----------------------------------------------------------------------------------


def test_union_by_name_with_equal_types(spark, tmp_path, rows):
    spark.sql("SELECT 1 a, 'x' b").write.parquet(f"{tmp_path}/m1")
    spark.sql("SELECT 2.5D c, 2 a").write.parquet(f"{tmp_path}/m2")
    df = sources.read_union_by_name(spark, f"{tmp_path}/*").select("a", "b", "c")
    assert rows(df) == [(1, "x", None), (2, None, 2.5)]


def test_union_by_name_widens_types_that_differ(spark, tmp_path, rows):
    spark.sql("SELECT 1 a, 1 f, 'x' b").write.parquet(f"{tmp_path}/m1")
    spark.sql("SELECT 2L a, 1.5D f, 'y' b").write.parquet(f"{tmp_path}/m2")
    spark.sql("SELECT 3L A, 2.5D f, 7 b").write.parquet(f"{tmp_path}/m3")
    df = sources.read_union_by_name(spark, f"{tmp_path}/*")
    assert [f.dataType.simpleString() for f in df.select("a", "f", "b").schema] == ["bigint", "double", "string"]
    assert rows(df.select("a", "f", "b")) == [(1, 1.0, "x"), (2, 1.5, "y"), (3, 2.5, "7")]


def test_union_by_name_keeps_folder_columns(spark, tmp_path, rows):
    for month, sql in [(202401, "SELECT 1 a"), (202402, "SELECT 2L a"), (202403, "SELECT 3 a")]:
        spark.sql(sql).write.parquet(f"{tmp_path}/t/year_month={month}")
    df = sources.read_union_by_name(spark, f"{tmp_path}/t")
    assert rows(df.select("year_month", "a")) == [(202401, 1), (202402, 2), (202403, 3)]


def test_union_by_name_keeps_columns_of_single_files(spark, tmp_path, rows):
    for sql in ("SELECT 1 a, 2 b", "SELECT 3 a, 4 c", "SELECT 5L a"):
        spark.sql(sql).write.mode("append").parquet(f"{tmp_path}/m1")
    spark.sql("SELECT 6L a, 7 d").write.parquet(f"{tmp_path}/m2")
    df = sources.read_union_by_name(spark, f"{tmp_path}/*").select("a", "b", "c", "d")
    assert df.schema["a"].dataType == T.LongType()
    assert rows(df) == [(1, 2, None, None), (3, None, 4, None), (5, None, None, None), (6, None, None, 7)]


def test_union_by_name_refuses_types_without_a_common_one(spark, tmp_path):
    spark.sql("SELECT true a").write.parquet(f"{tmp_path}/m1")
    spark.sql("SELECT 7 a").write.parquet(f"{tmp_path}/m2")
    with pytest.raises(TypeError, match="no common type"):
        sources.read_union_by_name(spark, f"{tmp_path}/*")


def _alternating(tmp_path, n):
    """Files whose types change by turns; a name needs escaping in a URI."""
    (tmp_path / "t").mkdir()
    for i in range(n):
        kind = (pa.int32(), pa.int64(), pa.float64())[i % 3]
        table = pa.table({"a": pa.array([i], kind), f"own_{i % 2}": [i]})
        pq.write_table(table, tmp_path / "t" / f"part {i:04d}.parquet")
    return str(tmp_path / "t")


def test_union_of_files_that_alternate_takes_one_census(spark, tmp_path, rows):
    path = _alternating(tmp_path, 1000)
    tracker, group = spark.sparkContext.statusTracker(), "census"
    spark.sparkContext.setJobGroup(group, "")
    df = sources.read_union_by_name(spark, path)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    # The refused merge, the listing, the census, six distinct footers, three merges and three scans: not one for each file.
    assert jobs <= 30
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {"a": "double", "own_0": "bigint", "own_1": "bigint"}
    assert df.count() == 1000 and df.where("a = coalesce(own_0, own_1)").count() == 1000
    assert str(df._jdf.queryExecution().optimizedPlan()).count("Relation [") == 3


def test_files_that_tasks_cannot_open_are_halved(spark, tmp_path, monkeypatch, rows):
    path = _alternating(tmp_path, 9)
    unread = lambda spark, files: spark.createDataFrame([(None, f) for f in files], "footer string, path string")
    monkeypatch.setattr(files, "schema_census", unread)
    df = sources.read_union_by_name(spark, path)
    assert rows(df.select("a")) == sorted([(float(i),) for i in range(9)])


def test_census_groups_columns_that_merge(spark, tmp_path, rows):
    spark.sql("SELECT 1 a, named_struct('x', 1) s, 1.25BD d").write.parquet(f"{tmp_path}/t/p=1")
    spark.sql("SELECT 2 a, named_struct('y', 'u') s, 111.25BD d").write.parquet(f"{tmp_path}/t/p=b")
    spark.sql("SELECT 3L a").write.parquet(f"{tmp_path}/t/p=c")
    spark.sql("SELECT 4L a").where("false").write.parquet(f"{tmp_path}/t/p=d")
    df = sources.read_union_by_name(spark, f"{tmp_path}/t")
    assert df.schema["s"].dataType.simpleString() == "struct<x:int,y:string>"
    assert rows(df.select("a", "p", "s.x", "s.y")) == [(1, "1", 1, None), (2, "b", None, "u"), (3, "c", None, None)]
    footers = sources.schema_census(spark, df.inputFiles()).groupBy("footer").count().collect()
    assert sorted(r["count"] for r in footers) == [1, 1, 2] and all(r.footer for r in footers)


def test_load_typed_refuses_overflow(spark):
    narrow = T.StructType([T.StructField("n", T.ShortType())])
    df = spark.sql("SELECT 70000L n")
    assert sources.load_typed(df, narrow, strict=False).first().n is None
    with pytest.raises(Exception, match="OVERFLOW"):
        sources.load_typed(df, narrow).collect()


def test_external_table(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/e")
    sources.register_external(spark, "ext_numbers", f"{tmp_path}/e")
    assert sources.register_external(spark, "ext_numbers", f"{tmp_path}/e").count() == 5
    spark.sql("DROP TABLE ext_numbers")
    assert spark.read.parquet(f"{tmp_path}/e").count() == 5


# ---- months ------------------------------------------------------------------------------------


def test_months_between():
    assert sources.months_between("2024-01-15", "2024-02-10") == [(2024, 1), (2024, 2)]
    assert sources.months_between("2024-01-15", "2024-02-10", strict_step=True) == [(2024, 1)]
    assert sources.months_between("2023-12-31", "2024-03-29", strict_step=True) == [
        (2023, 12), (2024, 1), (2024, 2), (2024, 3)
    ]
    assert sources.months_between("2024-02-20", "2024-02-10") == []
    assert sources.months_between("2024-02-20", "2024-02-10", strict_step=True) == []
    assert len(sources.months_between("2019-01-01", "2020-12-31")) == 24


def _month(spark, root, kind, year, month, sql):
    spark.sql(sql).write.parquet(sources.month_path(str(root), kind, year, month))


def test_ingest_skips_missing_and_empty_months(spark, tmp_path):
    yellow = "SELECT timestamp_ntz'2024-01-05' tpep_pickup_datetime, {} PULocationID, 5.0D fare_amount"
    _month(spark, tmp_path, "yellow", 2024, 1, yellow.format("1L"))
    _month(spark, tmp_path, "yellow", 2024, 3, yellow.format("2"))  # another type than January
    _month(spark, tmp_path, "yellow", 2024, 4, yellow.format("3") + " LIMIT 0")
    _month(spark, tmp_path, "yellow", 2024, 6, yellow.format("4"))  # outside the range
    _month(spark, tmp_path, "green", 2024, 2, "SELECT timestamp_ntz'2024-02-05' lpep_pickup_datetime, 1 payment_type")
    df = sources.ingest_months(spark, str(tmp_path), "2024-01-20", "2024-05-02", ["yellow", "green", "blue"])
    assert df.schema.simpleString() == NORMAL_TRIPS.simpleString()
    got = sorted((r.taxi_type, r.pickup_location_id or 0, r.payment_type or 0) for r in df.collect())
    assert got == [("green", 0, 1), ("yellow", 1, 0), ("yellow", 2, 0)]


def test_ingest_of_nothing_has_the_full_schema(spark, tmp_path):
    for root in (tmp_path, tmp_path / "absent"):
        df = sources.ingest_months(spark, str(root), "2024-01-01", "2024-02-01")
        assert df.schema.simpleString() == NORMAL_TRIPS.simpleString() and df.count() == 0


# ---- pages and snapshots -----------------------------------------------------------------------

ROW = T.StructType([T.StructField("n", T.LongType()), T.StructField("tip_amt", T.DoubleType())])


def _pages(root, pages):
    for number, rows in pages.items():
        folder = root / f"page={number}"
        folder.mkdir(parents=True)
        (folder / "data.json").write_text(json.dumps(rows, indent=1))
    return str(root)


@pytest.mark.parametrize("numbers, empty", [([1, 2, 3], []), ([1, 2, 4], [3]), ([2, 3], [1]), ([1], [2, 3])])
def test_all_pages_are_read(spark, tmp_path, numbers, empty):
    pages = {n: [{"n": n, "tip_amt": 0.5}, {"n": n}] for n in numbers} | {n: [] for n in empty}
    df = sources.read_json_pages(spark, _pages(tmp_path / "p", pages), ROW)
    got = sorted((r.page, r.n) for r in df.collect())
    assert got == sorted((n, n) for n in numbers for _ in range(2))


@pytest.mark.parametrize("numbers", [[1, 2, 4], [2, 3], [0, 1, 2], [1, 2, 10, 11]])
def test_a_gap_between_pages_is_an_error(spark, tmp_path, numbers):
    root = _pages(tmp_path / "p", {n: [{"n": n}] for n in numbers})
    with pytest.raises(ValueError, match="without a gap"):
        sources.read_json_pages(spark, root, ROW)


def test_latest_snapshot_by_name(spark, tmp_path):
    for name, n in [("data_20240101", 1), ("data_20240109", 2), ("data_2023", 3)]:
        spark.range(n).write.parquet(f"{tmp_path}/{name}/trips")
    spark.range(9).write.parquet(f"{tmp_path}/data_20240110/zones")
    spark.range(8).write.parquet(f"{tmp_path}/data_20240111/trips")
    os.remove(f"{tmp_path}/data_20240111/trips/_SUCCESS")  # still being written
    assert sources.read_latest_snapshot(spark, str(tmp_path), "trips").count() == 2
    with pytest.raises(FileNotFoundError):
        sources.read_latest_snapshot(spark, str(tmp_path), "fares")


def test_external_table_never_drops_a_managed_one(spark, tmp_path):
    spark.range(3).write.mode("overwrite").saveAsTable("owned_rows")
    spark.range(5).write.parquet(f"{tmp_path}/files")
    with pytest.raises(ValueError, match="not an external table"):
        sources.register_external(spark, "owned_rows", f"{tmp_path}/files")
    assert spark.table("owned_rows").count() == 3
    for _ in range(2):
        assert sources.register_external(spark, "outside_rows", f"{tmp_path}/files").count() == 5
    spark.sql("DROP TABLE owned_rows")
    spark.sql("DROP TABLE outside_rows")
