import glob
import gzip
import os
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripmill import functions as X
from tripmill import operators as op
from tripmill import sinks
from tripmill.session import shared_dir
from tripmill.sinks import journal


@pytest.fixture
def trips(spark):
    days = ["2024-01-05", "2024-01-25", "2024-02-10", "2024-02-29 23:59:59", "2024-03-03", "2024-03-20"]
    return spark.createDataFrame([(i, d, 1.0) for i, d in enumerate(days)], "id int, d string, v double").select(
        "id", F.col("d").cast("timestamp_ntz").alias("t"), "v"
    )


def test_n_files_and_stats(spark, tmp_path):
    path = f"{tmp_path}/four"
    sinks.write_n_files(spark.range(1_000), path, 4)
    sinks.write_n_files(spark.range(1_000), path, 4)
    files = glob.glob(f"{path}/*.parquet")
    stats = sinks.file_stats(spark, path).first()
    assert (stats.files, stats.bytes) == (4, sum(map(os.path.getsize, files))) and len(files) == 4
    assert spark.read.parquet(path).count() == 1_000


def test_n_files_share_rows_and_keep_their_order(spark, tmp_path):
    import pyarrow.parquet as pq

    # One task's rows, many tasks of a row each, fewer rows than files, and none.
    for k, (rows, parts, want) in enumerate([(1_000, 1, [250] * 4), (30, 30, [7, 7, 8, 8]), (2, 1, None), (0, 1, None)]):
        path = f"{tmp_path}/n{k}"
        sinks.write_n_files(spark.range(0, rows, 1, parts).withColumn("s", F.lit("x")), path, 4)
        files = [pq.read_table(f) for f in glob.glob(f"{path}/*.parquet")]
        held = [t.column("id").to_pylist() for t in files]
        assert sorted(i for ids in held for i in ids) == list(range(rows)) and all(t.column_names == ["id", "s"] for t in files)
        assert want is None or sorted(map(len, held)) == want
        assert (parts > 1 or all(ids == sorted(ids) for ids in held)) and 1 <= len(held) <= 4
    assert sorted(p.name for p in tmp_path.iterdir()) == ["n0", "n1", "n2", "n3"]


def test_chunks(spark, tmp_path):
    sinks.write_chunks(spark.range(0, 1_000, 1, 1), f"{tmp_path}/c", 300)
    assert len(glob.glob(f"{tmp_path}/c/*.parquet")) == 4


def test_layout_prunes_folders_and_sorts_files(spark, tmp_path):
    path = f"{tmp_path}/layout"
    df = spark.range(5_000).select(
        (F.col("id") % 7).alias("vendor"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id % 180))").alias("dropoff"),
    )
    sinks.write_layout(df, path, "dropoff", ["vendor", "dropoff"])
    assert len(glob.glob(f"{path}/year_month=*")) == 6
    inside = spark.read.parquet(path).filter(X.between_months("dropoff", "2024-03-01", "2024-03-15"))
    assert inside.count() == df.filter(X.in_interval("dropoff", "2024-03-01", "2024-03-15")).count()
    plan = inside._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "year_month#" in scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "GreaterThanOrEqual(dropoff" in scan
    for file in glob.glob(f"{path}/*/*.parquet"):
        got = [(r.vendor, r.dropoff) for r in spark.read.parquet(file).coalesce(1).collect()]
        assert got == sorted(got)


def test_append_doubles_and_replace_does_not(spark, trips, tmp_path):
    for _ in range(2):
        sinks.materialize(trips, f"{tmp_path}/a", "append")
        sinks.materialize(trips, f"{tmp_path}/am", "append", key="t")
        sinks.materialize(trips, f"{tmp_path}/r", "replace", key="t")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 12
    assert sinks.read_months(spark, f"{tmp_path}/am").count() == 12
    assert sinks.read_months(spark, f"{tmp_path}/r").count() == 6
    sinks.materialize(trips, "trips_view", "view")
    assert spark.table("trips_view").count() == 6
    with pytest.raises(ValueError):
        sinks.materialize(trips, f"{tmp_path}/x", "merge")


def _table(spark, path):
    return sorted((r.id, r.v) for r in sinks.read_months(spark, path).collect())


def _from_to(df, low, high):
    return df.filter(F.to_date("t").between(low, high))


def test_time_interval_refuses_rows_outside(spark, trips, tmp_path):
    path = f"{tmp_path}/t"
    sinks.materialize(trips, path, "replace", key="t")
    lost = trips.withColumn("t", F.when(F.col("id") != 2, F.col("t")))
    for rows in (trips, _from_to(trips, "2024-02-01", "2024-02-29").unionByName(lost.filter("id = 2"))):
        with pytest.raises(ValueError, match="nothing was written"):
            sinks.materialize(rows.withColumn("v", F.lit(9.0)), path, "time_interval", "t", "2024-02-01", "2024-02-29")
    assert {v for _, v in _table(spark, path)} == {1.0}


def test_time_interval_replaces_only_the_interval(spark, trips, tmp_path):
    path = f"{tmp_path}/t"
    sinks.materialize(trips, path, "replace", key="t")
    new = _from_to(trips.withColumn("v", F.lit(2.0)), "2024-01-20", "2024-03-03")
    for _ in range(2):  # a second run changes nothing
        sinks.materialize(new, path, "time_interval", "t", "2024-01-20", "2024-03-03")
        assert _table(spark, path) == [(0, 1.0), (1, 2.0), (2, 2.0), (3, 2.0), (4, 2.0), (5, 1.0)]
    assert not glob.glob(f"{path}/_staged*") + glob.glob(f"{path}/_journal*")


def test_time_interval_removes_a_month_left_empty(spark, trips, tmp_path):
    path = f"{tmp_path}/t"
    sinks.materialize(trips, path, "replace", key="t")
    new = _from_to(trips.filter("month(t) <> 2"), "2024-01-20", "2024-03-03")
    sinks.materialize(new, path, "time_interval", "t", "2024-01-20", "2024-03-03")
    assert [i for i, _ in _table(spark, path)] == [0, 1, 4, 5]
    assert not os.path.exists(f"{path}/year_month=202402")
    sinks.materialize(new.limit(0), path, "time_interval", "t", "2024-03-01", "2024-03-31")
    assert [i for i, _ in _table(spark, path)] == [0, 1]


def test_time_interval_fills_a_table_left_empty(spark, trips, tmp_path):
    path = f"{tmp_path}/t"
    sinks.materialize(trips, path, "replace", key="t")
    sinks.materialize(trips.filter("id < 0"), path, "time_interval", "t", "2024-01-01", "2024-12-31")
    assert not glob.glob(f"{path}/year_month=*")
    sinks.materialize(trips, path, "time_interval", "t", "2024-01-01", "2024-12-31")
    assert len(_table(spark, path)) == 6


def test_time_interval_bounds(spark, trips, tmp_path):
    path = f"{tmp_path}/t"
    new = _from_to(trips.withColumn("v", F.lit(3.0)), "2024-02-01", "2024-02-29")
    sinks.materialize(new, path, "time_interval", "t", "2024-02-01", "2024-02-29")  # no table yet
    assert _table(spark, path) == [(2, 3.0), (3, 3.0)]
    again = trips.withColumn("v", F.lit(4.0)).filter("t between '2024-02-10' and '2024-02-29 23:59:58'")
    sinks.materialize(
        again, path, "time_interval", "t", datetime(2024, 2, 10), datetime(2024, 2, 29, 23, 59, 58)
    )
    assert _table(spark, path) == [(2, 4.0), (3, 3.0)]


def test_replace_table(spark, tmp_path):
    sinks.replace_table(spark.range(3), "prod_test.numbers", f"{tmp_path}/w")
    assert sinks.replace_table(spark.range(5), "prod_test.numbers", f"{tmp_path}/w").count() == 5
    spark.sql("DROP DATABASE prod_test CASCADE")


def test_day_output(spark, tmp_path):
    for n in (2, 3):
        path = sinks.write_day(spark.range(n), str(tmp_path), 7)
    assert path.endswith("output_day=7") and spark.read.parquet(path).count() == 3


def test_convert_finishes_what_is_missing(spark, tmp_path):
    landed, target = tmp_path / "csv", str(tmp_path / "parquet")
    landed.mkdir()

    def land(month, *values):
        with gzip.open(landed / f"fhv_tripdata_2019-{month:02d}.csv.gz", "wt") as f:
            f.write("base,n\n" + "".join(f"B{month},{v}\n" for v in values))

    land(1, 10, 11)
    months = [(2019, m) for m in range(1, 13)]
    assert sinks.convert_months(spark, str(landed), target, "fhv", months) == [201901]
    land(1, 99)  # already converted, so not read again
    land(2, 20)
    assert sinks.convert_months(spark, str(landed), target, "fhv", months) == [201902]
    assert sinks.convert_months(spark, str(landed), target, "fhv", months) == []
    got = sorted((r.year_month, r.base, r.n) for r in spark.read.parquet(target).collect())
    assert got == [(201901, "B1", 10), (201901, "B1", 11), (201902, "B2", 20)]


def test_convert_repeats_a_month_without_its_mark(spark, tmp_path):
    landed, target = tmp_path / "csv", tmp_path / "parquet"
    landed.mkdir()
    for month in (1, 2):
        (landed / f"fhv_tripdata_2019-{month:02d}.csv").write_text(f"base,n\nB{month},{month}0\n")
    months = [(2019, 1), (2019, 2)]
    assert sinks.convert_months(spark, str(landed), str(target), "fhv", months) == [201901, 201902]
    (target / "_converted" / "201902").unlink()  # as if the run had been stopped while it committed
    assert sinks.convert_months(spark, str(landed), str(target), "fhv", months) == [201902]
    got = sorted((r.base, r.n) for r in spark.read.parquet(str(target)).collect())
    assert got == [("B1", 10), ("B2", 20)]


def test_convert_months_with_other_headers(spark, tmp_path):
    landed, target = tmp_path / "csv", str(tmp_path / "parquet")
    landed.mkdir()
    for month, text in [(1, "base,n\nB1,10\n"), (2, "n,base\n20,B2\n"), (3, "base,n,flag\nB3,30,x\n")]:
        (landed / f"fhv_tripdata_2019-{month:02d}.csv").write_text(text)
    sinks.convert_months(spark, str(landed), target, "fhv", [(2019, m) for m in range(1, 13)])
    got = spark.read.option("mergeSchema", True).parquet(target).orderBy("n").collect()
    assert [(r.base, r.n, r.flag) for r in got] == [("B1", 10, None), ("B2", 20, None), ("B3", 30, "x")]


def test_convert_keeps_the_types_of_the_target(spark, tmp_path):
    landed, target = tmp_path / "csv", str(tmp_path / "parquet")
    landed.mkdir()

    def land(month, text):
        (landed / f"fhv_tripdata_2019-{month:02d}.csv").write_text(text)

    months = [(2019, m) for m in range(1, 13)]
    land(1, "base,n\nB1,10\n")
    sinks.convert_months(spark, str(landed), target, "fhv", months)
    land(2, "base,n,m\nB2,20,7\n")
    assert sinks.convert_months(spark, str(landed), target, "fhv", months) == [201902]
    land(3, "base,n\nB3,many\n")
    with pytest.raises(Exception):
        sinks.convert_months(spark, str(landed), target, "fhv", months)
    got = spark.read.option("mergeSchema", True).parquet(target).orderBy("n").collect()
    assert [(r.base, r.n, r.m) for r in got] == [("B1", 10, None), ("B2", 20, 7)]


def test_convert_refuses_months_that_differ_before_writing(spark, tmp_path):
    landed, target = tmp_path / "csv", tmp_path / "parquet"
    landed.mkdir()
    (landed / "fhv_tripdata_2019-01.csv").write_text("base,n\nB1,10\n")
    (landed / "fhv_tripdata_2019-02.csv").write_text("n,base\nmany,B2\n")
    with pytest.raises(ValueError, match="declare a schema"):
        sinks.convert_months(spark, str(landed), str(target), "fhv", [(2019, 1), (2019, 2)])
    assert not target.exists()


def test_shared_dir_is_the_clusters(spark):
    parent = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(f"{parent}/x-")


def test_no_local_folder_on_a_cluster():
    class Session:
        conf = {"spark.master": "yarn"}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session, "x")


def test_publish_appends_json_lines(spark, tmp_path):
    messages = spark.createDataFrame([('{"n":1}',), ('{"n":2}',)], "value string")
    sinks.publish_json(messages, f"{tmp_path}/topic")
    sinks.publish_json(messages, f"{tmp_path}/topic")
    assert spark.read.json(f"{tmp_path}/topic").count() == 4


# ---- journals ------------------------------------------------------------------------------------


@pytest.mark.parametrize("step", ["create_new", "rename", "remove", "after"])
def test_an_interval_killed_in_its_commit_is_finished_by_the_next_run(spark, trips, tmp_path, monkeypatch, step):
    path = f"{tmp_path}/t"
    sinks.materialize(trips, path, "replace", key="t")
    before = _table(spark, path)
    new = _from_to(trips.withColumn("v", F.lit(9.0)), "2024-01-20", "2024-03-03")
    calls = []

    def dies(real, at):
        def call(*args):
            calls.append(args)
            if len(calls) == at:
                raise OSError("killed")
            return real(*args)

        return call

    with monkeypatch.context() as m:
        if step == "after":
            m.setattr(journal, "recover", dies(journal.recover, 1))
        else:
            m.setattr(journal, step, dies(getattr(journal, step), 1 if step == "create_new" else 2))
        with pytest.raises(OSError):
            sinks.materialize(new, path, "time_interval", "t", "2024-01-20", "2024-03-03")
    if step == "create_new":  # nothing was decided
        assert _table(spark, path) == before
        assert not sinks.recover(spark, path)
    else:
        # The next run, of another interval, first finishes what was decided.
        late = trips.filter("id < 0")
        sinks.materialize(late, path, "time_interval", "t", "2030-01-01", "2030-01-31")
        inside = {r.id for r in new.collect()}
        assert _table(spark, path) == [(i, 9.0 if i in inside else v) for i, v in before]
        assert not glob.glob(f"{path}/_journal*")
    sinks.materialize(new, path, "time_interval", "t", "2024-01-20", "2024-03-03")
    inside = {r.id for r in new.collect()}
    assert _table(spark, path) == [(i, 9.0 if i in inside else v) for i, v in before]


def test_a_journal_cut_off_decides_nothing(spark, trips, tmp_path):
    path = f"{tmp_path}/t"
    sinks.materialize(trips, path, "replace", key="t")
    before = _table(spark, path)
    with open(f"{path}/_journal.json", "w") as f:
        f.write('{"staged": "_sta')
    assert not sinks.recover(spark, path) and _table(spark, path) == before


def test_checked_write(spark, trips, tmp_path):
    path = f"{tmp_path}/t"
    rules = [op.not_null("id"), op.accepted_values("v", [1.0, 2.0]), op.unique("id")]
    good = trips.withColumn("v", F.lit(1.0))
    report = sinks.write_checked(good, path, rules)
    assert [(r.check, r.failing_rows, r.status) for r in report.collect()] == [
        ("not_null", 0, "pass"), ("accepted_values", 0, "pass"), ("unique", 0, "pass")]
    assert spark.read.parquet(path).count() == 6
    files = sorted(os.listdir(path))
    for bad in (good.withColumn("v", F.when(F.col("id") == 3, 7.0).otherwise(2.0)), good.union(good.limit(1))):
        for mode in ("append", "replace"):
            with pytest.raises(op.QualityError):
                sinks.write_checked(bad, path, rules, mode)
            assert sorted(os.listdir(path)) == files
    sinks.write_checked(good.limit(2), path, rules[:2], "append")
    assert spark.read.parquet(path).count() == 8
    sinks.write_checked(good.limit(2), path, rules, "replace")
    assert spark.read.parquet(path).count() == 2
    sinks.write_checked(good.limit(0), path, [], "replace")
    assert spark.read.parquet(path).count() == 0


def test_a_checked_write_scans_its_source_once(spark, trips, tmp_path):
    """The source counts its own rows: each was read once."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = spark.range(1000).mapInArrow(counted, "id long")
    sinks.write_checked(source, f"{tmp_path}/t", [op.not_null("id"), op.positive("id")][:1])
    assert reads.value == 1000


def test_a_filter_on_the_sort_column_opens_one_file_of_several(spark, tmp_path):
    path = f"{tmp_path}/layout"
    rows = spark.range(0, 40_000, 1, 4).select(
        (F.col("id") % 200).alias("vendor"), F.lit("2024-05-05").cast("timestamp_ntz").alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("note"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        sinks.write_layout(rows, path, "t", ["vendor", "t"])
    finally:
        spark.conf.set(coalesce, "true")
    ranges = []
    for file in glob.glob(f"{path}/year_month=202405/*.parquet"):
        footer = pq.ParquetFile(file).metadata
        groups = [footer.row_group(i).column(0).statistics for i in range(footer.num_row_groups)]
        ranges.append((min(g.min for g in groups), max(g.max for g in groups)))
    ranges.sort()
    assert len(ranges) > 3
    # Ranges meet at their ends at most, so a vendor lies in one file, or in two if it is at a bound.
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(low <= 17 <= high for low, high in ranges) == 1
