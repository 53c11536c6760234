"""Files named by kind and month."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmill.functions.predicates import as_date, next_month
from tripmill.operators.projections import normalize_trips, union_trips
from tripmill.schemas import NORMAL_TRIPS
from tripmill.sources.files import read_union_by_name
from tripmill.storage import child_names


def month_name(kind: str, year: int, month: int, suffix: str = "parquet") -> str:
    return f"{kind}_tripdata_{year}-{month:02d}.{suffix}"


def month_path(root: str, kind: str, year: int, month: int, suffix: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{month_name(kind, year, month, suffix)}"


def months_between(
    start: date | str, end: date | str, strict_step: bool = False
) -> list[tuple[int, int]]:
    """Every (year, month) that the closed range of days touches.

    ``strict_step`` steps a month at a time from the day of ``start`` and stops when that day is past
    ``end``, so 15 January to 10 February is January only.
    """
    start, end = as_date(start), as_date(end)
    months, current, day = [], start.replace(day=1), start.day
    while True:
        if strict_step:
            day = min(day, monthrange(current.year, current.month)[1])
        if current.replace(day=day if strict_step else 1) > end:
            return months
        if not months and start > end:
            return months
        months.append((current.year, current.month))
        current = next_month(current)


def ingest_months(
    spark: SparkSession,
    root: str,
    start: date | str,
    end: date | str,
    kinds: Sequence[str] = ("yellow",),
    renames: dict[str, dict[str, str]] | None = None,
    schema: T.StructType = NORMAL_TRIPS,
    strict: bool = True,
    strict_step: bool = False,
) -> DataFrame:
    """Trips of all kinds and months in the range, normalised. Months without a file are skipped.

    One folder listing finds the files. The months of a kind become one scan (or one per distinct
    schema), so the plan stays small for many years. Without any file the result is empty with the
    full schema.
    """
    present = set(child_names(spark, root))
    frames = []
    for kind in kinds:
        wanted = [
            month_name(kind, year, month)
            for year, month in months_between(start, end, strict_step)
        ]
        paths = [f"{root.rstrip('/')}/{name}" for name in wanted if name in present]
        if paths:
            df = read_union_by_name(spark, paths)
            frames.append(normalize_trips(df, kind, (renames or {}).get(kind), schema, strict))
    return union_trips(*frames) if frames else spark.createDataFrame([], schema)
