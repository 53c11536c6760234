"""Run a registered query and its SQL on the same tables and describe how they differ."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Spark type -> the names under which the SQL engine may give the same values.
_SAME = {
    T.LongType: {"BIGINT"},
    T.BooleanType: {"BOOLEAN"},
    T.IntegerType: {"INTEGER"},
    T.ShortType: {"SMALLINT"},
    T.DoubleType: {"DOUBLE"},
    T.FloatType: {"FLOAT"},
    T.StringType: {"VARCHAR"},
    T.DateType: {"DATE"},
    T.TimestampNTZType: {"TIMESTAMP"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else f"{value:.9g}")
    return (1, str(value))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, types, row count and values agree."""
    result = con.execute(sql)
    wanted = {d[0]: str(d[1]) for d in result.description}
    if sorted(wanted) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(wanted)}"
    for f in df.schema.fields:
        if wanted[f.name] not in _SAME[type(f.dataType)]:
            return f"{f.name} is {f.dataType.simpleString()} against {wanted[f.name]}"
    names = sorted(wanted)
    order = [list(wanted).index(n) for n in names]
    expected = sorted(tuple(_canonical(r[i]) for i in order) for r in result.fetchall())
    got = sorted(tuple(_canonical(r[n]) for n in names) for r in df.collect())
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{dict(zip(names, a))} against {dict(zip(names, b))}"
    return None
