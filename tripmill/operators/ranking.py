"""Sorts and top-k; with a limit Spark keeps only k rows per task (TakeOrderedAndProject)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ties(ties: Sequence[str]):
    return [F.asc_nulls_last(c) for c in ties]


def top_n(df: DataFrame, by: str, n: int = 1, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``by``; equal ones in ascending order of ``ties``."""
    return df.orderBy(F.desc_nulls_last(by), *_ties(ties)).limit(n)


def bottom_n(df: DataFrame, by: str, n: int = 1, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(by), *_ties(ties)).limit(n)


def sort_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)
