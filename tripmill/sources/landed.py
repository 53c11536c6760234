"""Data that another job has landed: numbered JSON pages and named snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmill.storage import child_names, exists


def read_json_pages(
    spark: SparkSession, root: str, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of all of ``root/page=N/*.json``, each file a JSON array.

    Pages are numbered from 1 without a gap; a missing one was lost on its way here, so that is an
    error and not an end. An empty page has no rows. Without ``schema`` the types are found from the data, by
    one more pass.
    """
    numbers = {int(n[5:]) for n in child_names(spark, root) if n.startswith("page=") and n[5:].isdigit()}
    lost = sorted(set(range(1, max(numbers, default=0) + 1)) ^ numbers)
    if lost:
        raise ValueError(f"pages of {root} are not numbered from 1 without a gap: see {lost[:10]}")
    reader = spark.read
    if schema:
        reader = reader.schema(
            T.StructType([*schema.fields, T.StructField("page", T.IntegerType())])
        )
    return reader.json(root, multiLine=True)


def read_latest_snapshot(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """The last snapshot folder by name; with ``table`` the last that contains it.

    Only names are listed; files of older snapshots are never opened. A folder without the mark that
    ends a write is still being written, or was given up, and does not count.
    """
    suffix = f"/{table}" if table else ""
    for name in reversed(child_names(spark, root)):
        path = f"{root.rstrip('/')}/{name}{suffix}"
        if exists(spark, f"{path}/_SUCCESS") or (not table and _marked(spark, path)):
            return spark.read.parquet(path)
    raise FileNotFoundError(f"no snapshot with {table or 'data'} in {root}")


def _marked(spark: SparkSession, path: str) -> bool:
    """Whether a snapshot of several tables has any, and all of them are complete."""
    tables = child_names(spark, path)
    return bool(tables) and all(exists(spark, f"{path}/{t}/_SUCCESS") for t in tables)
