"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import pytest

import __spark_entry__ as entry
from tripmill import plans
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
# Those of the optional subpackage have tests of their own.
QUERIES, ORACLES = plans.QUERIES, plans.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def built(spark):
    """Each query is built once; building some of them writes a table."""
    frames = {}

    def build(name):
        if name not in frames:
            frames[name] = QUERIES[name](spark, SF_DIR)
        return frames[name]

    return build


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(built, con, name):
    assert differences(built(name), con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def _plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, parts",
    [
        ("zero_value_count", ["EqualTo(l_discount,0.0)", "ReadSchema: struct<l_discount:double>"]),
        ("distinct_in_interval", ["GreaterThanOrEqual(ts,2024-01-05", "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>"]),
        ("day_trip_count", ["GreaterThanOrEqual(ts,2024-01-15", "LessThan(ts,2024-01-16"]),
        ("two_columns", ["ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>"]),
        ("staging_dedup", ["row_number(), 1, Partial", "row_number(), 1, Final"]),
        ("longest_session", ["TakeOrderedAndProject"]),
        ("session_counts", ["partial_min(ts", "partial_max(ts"]),
        ("least_frequent_zone", ["TakeOrderedAndProject", "partial_count"]),
        ("partition_layout", ["PartitionFilters: [isnotnull(year_month"]),
        ("top_zone_of_year", ["EqualTo(o_orderpriority,1-URGENT), GreaterTh"]),
        ("month_total", ["EqualTo(o_orderpriority,1-URGENT), GreaterTh"]),
    ],
)
def test_plan_has(built, name, parts):
    plan = _plan(built(name))
    for part in parts:
        assert part in plan, plan


def test_share_of_total_scans_once(built):
    assert "ReusedExchange" in _plan(built("payment_mix"), run=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_product_and_no_python(built, name):
    plan = _plan(built(name))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
