"""Write strategies of a table: append, replace, view, re-runnable time interval, and writes behind checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.predicates import as_date, month_number
from tripmill.operators.quality import REPORT, QualityError, Rule, check
from tripmill.sinks.files import MONTH, by_month, with_month
from tripmill.sinks.journal import commit, files_below, recover, staging
from tripmill.sources.months import months_between
from tripmill.storage import child_names, remove

STRATEGIES = ("append", "replace", "view", "time_interval")


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """A table written with a ``key``, without its month column."""
    return spark.read.parquet(path).drop(MONTH)


def materialize(
    df: DataFrame,
    target: str,
    strategy: str = "append",
    key: str | None = None,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
) -> None:
    """Write ``df`` to the table at path ``target`` (for ``view``: the view's name).

    ``append`` never looks at what is there, so a second run doubles the rows. ``replace`` rebuilds.
    ``time_interval`` deletes and inserts, see ``replace_interval``. With ``key`` the table has one
    folder per month of that column.
    """
    if strategy == "view":
        df.createOrReplaceTempView(target)
    elif strategy == "time_interval":
        replace_interval(df, target, key, start, end)
    elif strategy in ("append", "replace"):
        mode = "append" if strategy == "append" else "overwrite"
        if key:
            by_month(with_month(df, key)).write.mode(mode).partitionBy(MONTH).parquet(target)
        else:
            df.write.mode(mode).parquet(target)
    else:
        raise ValueError(f"strategy {strategy!r} is none of {', '.join(STRATEGIES)}")


def _inside(key: str, start: date | datetime | str, end: date | datetime | str) -> Column:
    """Rows of the interval. Days count whole, so a date as ``end`` includes that day."""
    whole_day = len(end) <= 10 if isinstance(end, str) else not isinstance(end, datetime)
    low = F.col(key) >= F.lit(str(start))
    if whole_day:
        return low & (F.col(key) < F.lit(str(as_date(end) + timedelta(days=1))))
    return low & (F.col(key) <= F.lit(str(end)))


def replace_interval(
    df: DataFrame,
    path: str,
    key: str,
    start: date | datetime | str,
    end: date | datetime | str,
) -> None:
    """Delete the table's rows whose ``key`` lies in the interval and insert ``df``.

    Rows of ``df`` outside the interval, or without a key, are refused before anything is written.

    Running it twice leaves the same table. Only the months of the interval are written. Of those
    only the first and the last can hold rows outside it, which are written anew with the others. A month
    that is left without rows is removed.

    New months are written whole beside the table, then a journal decides the change (see ``journal``): a run
    that dies before leaves the table as it was; of one that dies after, the next run finishes
    the change first. No row outside the interval is ever in one place only.
    """
    spark = df.sparkSession
    recover(spark, path)
    inside = _inside(key, start, end)
    astray = df.filter(~F.coalesce(inside, F.lit(False))).count()
    if astray:
        raise ValueError(f"{astray} rows have no {key} from {start} to {end}; nothing was written")
    out = with_month(df, key)
    if child_names(spark, path):
        edges = F.col(MONTH).isin(month_number(start), month_number(end))
        out = out.unionByName(spark.read.parquet(path).filter(edges & ~inside))
    staged = staging(path)
    by_month(out).write.partitionBy(MONTH).parquet(staged)
    months = [f"{MONTH}={y * 100 + m}" for y, m in months_between(as_date(start), as_date(end))]
    filled = [name for name in child_names(spark, staged) if name.startswith(f"{MONTH}=")]
    commit(spark, path, staged, files_below(spark, staged, filled), files_below(spark, path, months))


def write_checked(df: DataFrame, path: str, rules: Sequence[Rule], mode: str = "append") -> DataFrame:
    """Write ``df`` if it passes ``rules``; returns the report. ``mode`` is ``append`` or ``replace``.

    Row rules are counted by the write itself (an observation of its tasks' rows), so the source is
    scanned once; a unique rule groups the rows just written. If a rule fails, QualityError is raised and
    the table is as it was: rows are written beside it first, and a journal moves them in.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode {mode!r} is neither append nor replace")
    spark = df.sparkSession
    recover(spark, path)
    rowwise = [r for r in rules if r.fails]
    seen = Observation()
    counted = [F.count_if(r.fails(F.col(r.column))).alias(f"_{i}") for i, r in enumerate(rowwise)]
    staged = staging(path)
    # An empty list of rules observes the number of rows.
    df.observe(seen, *(counted or [F.count(F.lit(1)).alias("_rows")])).write.parquet(staged)
    found = seen.get
    report = [(r.check, r.column, int(found[f"_{i}"])) for i, r in enumerate(rowwise)]
    grouped = [r for r in rules if r.keys]
    if grouped:
        report += [(r.check, r.column, r.failing_rows) for r in check(spark.read.parquet(staged), grouped).collect()]
    failed = [f"{rule}({column}): {n}" for rule, column, n in report if n]
    if failed:
        remove(spark, staged)
        raise QualityError(", ".join(failed))
    commit(spark, path, staged, files_below(spark, staged), files_below(spark, path) if mode == "replace" else [])
    rows = [(rule, column, n, "pass") for rule, column, n in report]
    return spark.createDataFrame(rows, REPORT)


def replace_table(df: DataFrame, name: str, location: str | None = None) -> DataFrame:
    """Create the database if absent, create or replace the table, return it.

    ``location`` is the parent folder of the table's files; else the warehouse folder is used.
    """
    spark = df.sparkSession
    database, _, table = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    options = {"path": f"{location.rstrip('/')}/{table}"} if location else {}
    df.write.mode("overwrite").format("parquet").saveAsTable(name, **options)
    return spark.table(name)
