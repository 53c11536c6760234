"""Declared sources: one value per source, from which its reader, its checks and its freshness follow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import schemas as S
from tripmill.operators.quality import Rule, accepted_values, check, check_schema, freshness, not_null, unique
from tripmill.sources.files import read_trips

REPORT = "source string, check string, column string, failing_rows bigint, status string"


@dataclass(frozen=True)
class Source:
    """A raw table as its description declares it.

    ``codes`` lists the accepted values of a column; NULL is none of them and passes. ``required``
    columns are never NULL; ``keys`` name each row once. ``loaded_at`` is the column whose newest value
    is the source's age, which warns and errs after the given times.
    """

    name: str
    schema: T.StructType
    codes: Mapping[str, Sequence] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    loaded_at: str | None = None
    warn_after: timedelta = timedelta(hours=24)
    error_after: timedelta = timedelta(hours=48)

    def __post_init__(self):
        named = [*self.codes, *self.required, *self.keys, *([self.loaded_at] if self.loaded_at else [])]
        if strange := sorted(set(named) - set(self.schema.names)):
            raise ValueError(f"{self.name} declares no columns {strange}")

    def read(self, spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
        """Parquet files in the declared schema; no footer is opened before the query runs."""
        return read_trips(spark, path, schema=self.schema)

    def rules(self) -> list[Rule]:
        return [
            *[not_null(c) for c in self.required],
            *[accepted_values(c, list(values)) for c, values in self.codes.items()],
            *([unique(*self.keys)] if self.keys else []),
        ]

    def staged(self, df: DataFrame) -> DataFrame:
        """Rows whose required columns are all there: what raw data may contain, staging filters."""
        return df.dropna(subset=list(self.required)) if self.required else df

    def report(self, df: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
        """One row per declared column and rule, and one for the age at ``as_of``.

        Columns: source, check, column, failing_rows, status. All row rules share one pass over ``df``; a
        key adds one grouped pass, the age one aggregate. A rule on a column that is missing or has another
        type is left to the schema's own row, which fails.
        """
        spark = df.sparkSession
        columns = check_schema(df, self.schema)
        found = [(r.column, r.status) for r in columns.collect()]  # one row per column
        fit = {c for c, status in found if status in ("pass", "type")}
        rows = [(self.name, "schema", c, 0 if status in ("pass", "surplus") else 1,
                 {"pass": "pass", "surplus": "warn"}.get(status, "fail")) for c, status in found]
        rules = [r for r in self.rules() if set(r.keys or (r.column,)) <= fit]
        whole = spark.createDataFrame(rows, REPORT)
        if rules:
            whole = whole.unionByName(check(df, rules).withColumn("source", F.lit(self.name)))
        if self.loaded_at in fit and as_of is not None:
            age = freshness(df, self.loaded_at, as_of, self.warn_after, self.error_after)
            whole = whole.unionByName(age.select(
                F.lit(self.name).alias("source"), F.lit("freshness").alias("check"),
                F.lit(self.loaded_at).alias("column"),
                (F.col("status") != "pass").cast("bigint").alias("failing_rows"), "status"))
        return whole


GREEN = Source(
    "green_tripdata", S.GREEN_RAW,
    codes={"vendorid": S.VENDOR_CODES, "ratecodeid": S.RATE_CODES, "store_and_fwd_flag": S.FLAG_CODES,
           "payment_type": S.PAYMENT_CODES, "trip_type": S.TRIP_TYPE_CODES},
    required=("vendorid",), loaded_at="lpep_pickup_datetime",
)
YELLOW = Source(
    "yellow_tripdata", S.YELLOW_CSV,
    codes={"VendorID": S.VENDOR_CODES, "RatecodeID": S.RATE_CODES, "store_and_fwd_flag": S.FLAG_CODES,
           "payment_type": S.PAYMENT_CODES},
    required=("VendorID",), loaded_at="tpep_pickup_datetime",
)
FHV = Source(
    "fhv_tripdata",
    T.StructType([T.StructField(S.FHV_SOURCES[f.name], f.dataType) for f in S.FHV_STAGED.fields]),
    required=("dispatching_base_num",), loaded_at="pickup_datetime",
)
SOURCES = {s.name: s for s in (GREEN, YELLOW, FHV)}


def report_all(
    tables: Mapping[str, DataFrame], as_of: datetime | str, sources: Mapping[str, Source] = SOURCES
) -> DataFrame:
    """The reports of several sources, by name, as one."""
    parts = [sources[name].report(df, as_of) for name, df in tables.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
