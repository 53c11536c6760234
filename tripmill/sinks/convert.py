"""CSV months to Parquet months."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.sinks.files import MONTH, by_month
from tripmill.sources.files import csv_header, read_csv_inferred, read_trips_csv
from tripmill.sources.months import month_name
from tripmill.storage import child_names, mark


def convert_months(
    spark: SparkSession,
    source: str,
    target: str,
    kind: str,
    months: Sequence[tuple[int, int]],
    schema: T.StructType | None = None,
) -> list[int]:
    """Convert the months of ``kind`` that ``target`` lacks; returns their numbers, 201903 for March 2019.

    Each month becomes the folder ``target/year_month=N``. It counts as converted when the job that
    wrote it has committed and left a mark below ``target/_converted``; a run stopped before that is
    done again by the next, which replaces the folder. The missing months of one header line are one
    Spark job, a gzip file per task. Types are declared by ``schema``, else those that the target has;
    a value that does not fit fails its job before that commits. Only for a new target, and for columns
    that it lacks, they are found from the data; months that then differ are refused before any write.
    """
    landed = set(child_names(spark, source))
    marks = f"{target.rstrip('/')}/_converted"
    done = set(child_names(spark, marks))
    todo: dict[int, str] = {}
    for year, month in months:
        number = year * 100 + month
        names = [month_name(kind, year, month, s) for s in ("csv.gz", "csv")]
        found = next((n for n in names if n in landed), None)
        if found and str(number) not in done:
            todo[number] = f"{source.rstrip('/')}/{found}"
    if not todo:
        return []
    groups = _alike(spark, list(todo.values()))
    kinds = schema
    if kinds is None and done:
        kinds = spark.read.option("mergeSchema", True).parquet(target).drop(MONTH).schema
    frames = [_read(spark, paths, kinds, declared=schema is not None) for paths in groups]
    _agree(frames)
    for df in frames:
        _write(df, kind, target)
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda number: mark(spark, f"{marks}/{number}"), todo))
    return sorted(todo)


def _alike(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Paths grouped by their header line."""
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda path: tuple(csv_header(spark, path)), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        groups.setdefault(header, []).append(path)
    return list(groups.values())


def _read(
    spark: SparkSession, paths: Sequence[str], kinds: T.StructType | None, declared: bool
) -> DataFrame:
    """CSV in the given types; columns of the header that these lack are kept unless ``declared``."""
    if kinds is None:
        return read_csv_inferred(spark, paths)
    if declared:
        return read_trips_csv(spark, paths, kinds)
    names = {f.name.lower() for f in kinds.fields}
    surplus = [c for c in csv_header(spark, paths) if c.lower() not in names]
    if surplus:
        found = read_csv_inferred(spark, paths).select(*surplus).schema
        kinds = T.StructType([*kinds.fields, *found.fields])
    return read_trips_csv(spark, paths, kinds)


def _agree(frames: Sequence[DataFrame]) -> None:
    """Refuse, before anything is written, a column that has different types in different months."""
    types: dict[str, T.DataType] = {}
    for f in (f for df in frames for f in df.schema.fields):
        if types.setdefault(f.name.lower(), f.dataType) != f.dataType:
            raise ValueError(f"{f.name} has different types in different months: declare a schema")


def _write(df: DataFrame, kind: str, target: str) -> None:
    name = F.regexp_extract(
        F.input_file_name(), rf"{kind}_tripdata_(\d{{4}}-\d{{2}})\.csv", 1
    )
    month = F.replace(name, F.lit("-"), F.lit("")).cast("int")
    (
        by_month(df.withColumn(MONTH, month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(target)
    )
