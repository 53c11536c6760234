"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tripmill.session import apply_defaults
from tripmill.sources import read_trips

# Schemas of the test tables that queries read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
}

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its own name, with the equal SQL where there is one."""

    def register(build: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(apply_defaults(spark), sf_dir)

        prepared.__name__ = build.__name__
        prepared.__doc__ = build.__doc__
        QUERIES[build.__name__] = prepared
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(
    spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """A test table by its declared schema, or by the one in its footer if none is declared."""
    return read_trips(spark, f"{sf_dir}/{name}.parquet", columns, SCHEMAS.get(name))
