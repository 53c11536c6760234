"""Analytic functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def moving_average(
    daily: DataFrame,
    day: str,
    columns: Mapping[str, str],
    rows: int = 7,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Mean over the last ``rows`` rows (not days), shorter at the start; ``columns`` maps new to old.

    Takes a daily roll-up; a second row of one day (and key) is refused when the query runs. Without
    keys the frame runs in one task, which is safe for that: ``day`` must be a date, rows are grouped
    per day before they get there, and there are fewer than 3.7 million dates from year 1 to 9999.
    """
    if not isinstance(daily.schema[day].dataType, T.DateType):
        raise TypeError(f"{day} must be a date: roll up per day first")
    rest = [c for c in daily.columns if c != day and c not in keys]
    once = daily.groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest]
    )
    single = F.when(F.col("_n") == 1, F.col(day)).otherwise(
        F.raise_error(F.lit(f"moving_average: more than one row of one {day}; roll up per day first"))
    )
    once = once.withColumn(day, single).select(*daily.columns)
    frame = Window.partitionBy(*keys).orderBy(day).rowsBetween(1 - rows, 0)
    return once.withColumns({new: F.avg(old).over(frame) for new, old in columns.items()})


def share_of_total(df: DataFrame, c: str, name: str = "share") -> DataFrame:
    """``c`` divided by its sum over all rows.

    The sum is a scalar subquery: no row moves to a single task, and Spark reuses the shuffle that
    ``df`` ends with, so a grouped ``df`` is computed once.
    """
    whole = df.agg(F.sum(c).alias("whole")).scalar()
    return df.withColumn(name, F.try_divide(F.col(c), whole))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties decided by all other columns.

    Spark limits each group to one row inside every task before the shuffle (WindowGroupLimit), so
    a key with very many copies ships one row per task.
    """
    ties = [c for c in df.columns if c not in keys]
    frame = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(frame)).filter("_rank = 1").drop("_rank")
