import random
import re
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill import streaming

BASE = datetime(2024, 1, 1)
AGGS = {"n": ("count", None), "total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v")}


def _frame(spark, rows):
    return spark.createDataFrame(
        [(k, BASE + timedelta(seconds=s), v) for k, s, v in rows], "k string, t timestamp_ntz, v long"
    )


def _brute_sessions(rows, gap):
    found = []
    for key in {k for k, _, _ in rows}:
        mine = sorted((s, v) for k, s, v in rows if k == key)
        group = [mine[0]]
        for item in [*mine[1:], None]:
            if item and item[0] - group[-1][0] <= gap:
                group.append(item)
                continue
            values = [v for _, v in group]
            found.append(
                (BASE + timedelta(seconds=group[0][0]), BASE + timedelta(seconds=group[-1][0] + gap),
                 key, len(group), sum(values), min(values), max(values))
            )
            group = [item]
    return sorted(found, key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.integers(-900, 900), st.integers(-3, 3).map(lambda i: i * 300)),
            st.integers(-5, 5),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_sessions_equal_brute_force(spark, rows):
    df = streaming.sessions(_frame(spark, rows), "t", "5 minutes", ["k"], AGGS)
    assert sorted((tuple(r) for r in df.collect()), key=str) == _brute_sessions(rows, 300)


def test_sessions_with_a_hot_key(spark, rows):
    draw = random.Random(5)
    data = [("hot", draw.randrange(0, 400_000), 1) for _ in range(4_000)]
    data += [(f"k{draw.randrange(50)}", draw.randrange(0, 400_000), 1) for _ in range(2_000)]
    df = _frame(spark, data)
    ours = streaming.sessions(df, "t", "5 minutes", ["k"])
    plain = (
        df.groupBy(F.session_window("t", "5 minutes").alias("w"), "k").count()
        .select("w.start", "w.end", "k", "count")
    )
    assert rows(ours) == rows(plain)


def test_a_gap_of_exactly_the_limit_merges(spark):
    df = _frame(spark, [("a", 10, 1), ("a", 310, 1), ("b", 10, 1), ("b", 311, 1)])
    found = streaming.sessions(df, "t", "5 minutes", ["k"])
    assert {r.k: r.n for r in found.groupBy("k").agg(F.count("*").alias("n")).collect()} == {"a": 1, "b": 2}


def test_sessions_ask_for_a_key(spark):
    with pytest.raises(ValueError):
        streaming.sessions(_frame(spark, [("a", 1, 1)]), "t", "5 minutes", [])


def test_tumbling(spark, rows):
    df = _frame(spark, [("a", 0, 1), ("a", 299, 2), ("a", 300, 4), ("b", 10, 8), (None, 20, 16)])
    df = df.union(df.limit(1).withColumn("t", F.lit(None).cast("timestamp_ntz")))  # no time, no window
    at = [BASE + timedelta(minutes=m) for m in (0, 5, 10, 60)]
    assert rows(streaming.tumbling(df, "t", "5 minutes", ["k"])) == sorted(
        [(at[0], at[1], "a", 2), (at[0], at[1], "b", 1), (at[0], at[1], None, 1), (at[1], at[2], "a", 1)],
        key=lambda r: [(v is None, str(v)) for v in r],
    )
    hourly = streaming.tumbling(df, "t", "1 hour", aggs={"tips": ("sum", "v")})
    assert rows(hourly) == [(at[0], at[3], 31)]


def test_closed_windows(spark):
    df = _frame(spark, [("a", 0, 1), ("a", 304, 1)])
    windows = streaming.tumbling(df, "t", "5 minutes", ["k"])
    assert streaming.closed_windows(windows, df, "t", "window_end").count() == 0
    later = df.union(_frame(spark, [("a", 305, 1)]))
    assert streaming.closed_windows(windows, later, "t", "window_end").count() == 1


def test_event_time_from_text(spark):
    df = spark.createDataFrame([("2025-10-01 08:00:00",), ("soon",), (None,)], "s string")
    assert [r.event_time for r in streaming.with_event_time(df, "s").collect()] == [
        datetime(2025, 10, 1, 8), None, None
    ]
    assert streaming.unparsed_times(df, "s").count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", None]), st.integers(-6, 30).map(lambda i: i * 150), st.integers(-5, 5)),
        min_size=1, max_size=40,
    ),
    st.sampled_from([1, 2, 5]),
)
def test_sessions_across_forced_spans_equal_brute_force(spark, rows, cells):
    df = streaming.eventtime._batch_sessions(_frame(spark, rows), "t", "5 minutes", ["k"], AGGS, span_cells=cells)
    assert sorted((tuple(r) for r in df.collect()), key=str) == _brute_sessions(rows, 300)


def test_a_hot_key_is_strung_in_spans(spark):
    """One key, 20,000 sessions in 40,000 cells: no window sees more of it than a span, or the edges of spans."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") >= 0, "hot").alias("k"), (F.lit(BASE) + F.make_dt_interval(secs=F.col("id") * 700)).cast("timestamp_ntz").alias("t"))
    found = streaming.sessions(rows, "t", "5 minutes", ["k"])
    assert found.count() == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_span" in plan and "_alone" in plan
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # Keys alone partition nothing: each exchange also has the cell, the span or the session that stands alone.
    assert dealt and all(len(re.findall(r"\w+#", by)) > 1 for by in dealt)
