import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import functions as X
from tripmill import streaming as st
from tripmill.storage import create_new

MESSAGE = T.StructType(
    [
        T.StructField("at", T.StringType()),
        T.StructField("zone", T.IntegerType()),
        T.StructField("tip", T.DoubleType()),
    ]
)


class Topic:
    """A folder of JSON lines; every file is one micro-batch, in the order of writing."""

    def __init__(self, root):
        self.root, self.files = root / "topic", 0
        self.root.mkdir()
        self.out, self.checkpoint = str(root / "out"), str(root / "checkpoint")

    def send(self, *rows):
        path = self.root / f"{self.files:03d}.json"
        path.write_text("".join(json.dumps(dict(zip(("at", "zone", "tip"), r))) + "\n" for r in rows))
        os.utime(path, (1_700_000_000 + self.files,) * 2)
        self.files += 1

    def stream(self, spark):
        raw = st.stream_trips(spark, MESSAGE, path=str(self.root), max_files=1)
        return st.with_event_time(raw, "at")


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path)


def at(text):
    return f"2025-10-01 {text}"


def _counts(df):
    return sorted((r.window_start.strftime("%H:%M"), r.zone, r.num_trips) for r in df.collect())


def test_windows_close_once_and_late_rows_are_dropped(spark, topic):
    topic.send((at("08:00:01"), 1, 1.0), (at("08:01:00"), 1, 1.0), (at("08:02:00"), 2, 1.0))
    topic.send((at("08:05:04"), 1, 1.0))  # watermark 08:04:59
    topic.send((at("08:04:59"), 1, 1.0))  # out of order but in time
    topic.send((at("08:20:00"), 1, 1.0), ("never", 1, 1.0))
    topic.send((at("08:21:00"), 1, 1.0))
    topic.send((at("08:03:00"), 1, 1.0))  # late: its window has left
    counts = st.tumbling(topic.stream(spark), "event_time", "5 minutes", ["zone"])
    st.run(counts, st.append_sink(topic.out), topic.checkpoint)
    assert _counts(st.read_appended(spark, topic.out)) == [
        ("08:00", 1, 3), ("08:00", 2, 1), ("08:05", 1, 1)
    ]


@pytest.mark.parametrize("own_sink", [True, False])
def test_restart_goes_on_where_it_stopped(spark, topic, own_sink):
    topic.send((at("08:00:01"), 1, 1.0), (at("08:10:00"), 1, 1.0))

    def go():
        counts = st.tumbling(topic.stream(spark), "event_time", "5 minutes", ["zone"])
        st.run(counts, st.append_sink(topic.out) if own_sink else topic.out, topic.checkpoint)
        read = st.read_appended(spark, topic.out) if own_sink else spark.read.parquet(topic.out)
        return _counts(read)

    assert go() == [("08:00", 1, 1)]
    assert go() == [("08:00", 1, 1)]
    topic.send((at("08:30:00"), 1, 1.0))
    assert go() == [("08:00", 1, 1), ("08:10", 1, 1)]


def test_sessions_of_a_stream_equal_those_of_the_batch(spark, topic, rows):
    topic.send((at("08:00:00"), 1, 1.0), (at("08:05:00"), 1, 2.0), (at("08:00:30"), 2, 1.0))
    topic.send((at("08:10:01"), 1, 4.0), (at("08:09:00"), 2, 1.0))
    topic.send((at("09:00:00"), 3, 1.0))
    topic.send((at("09:00:01"), 3, 1.0))
    aggs = {"num_trips": ("count", None), "tips": ("sum", "tip")}
    found = st.sessions(topic.stream(spark), "event_time", "5 minutes", ["zone"], aggs)
    st.run(found, st.append_sink(topic.out), topic.checkpoint)
    batch = st.with_event_time(st.read_topic(spark, MESSAGE, path=str(topic.root)), "at")
    wanted = st.sessions(batch, "event_time", "5 minutes", ["zone"], aggs)
    closed = st.closed_windows(wanted, batch, "event_time", "session_end")
    got = st.read_appended(spark, topic.out)
    zone_free = got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
    assert rows(zone_free.select(*closed.columns)) == rows(closed)
    assert closed.count() == 4 and wanted.count() == 5


def test_hourly_sum_without_a_key(spark, topic):
    topic.send((at("08:00:01"), 1, 1.5), (at("08:59:59"), 2, 2.0), (at("10:00:00"), 1, 9.0))
    tips = st.tumbling(topic.stream(spark), "event_time", "1 hour", aggs={"tips": ("sum", "tip")})
    st.run(tips, st.append_sink(topic.out), topic.checkpoint)
    got = [(r.window_start, r.tips) for r in st.read_appended(spark, topic.out).collect()]
    assert got == [(datetime(2025, 10, 1, 8), 3.5)]


def test_upsert_keeps_the_newest_row_of_each_key(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    sink = st.upsert_sink(path)

    def batch(*data):
        return spark.createDataFrame(data, "k string, v int")

    sink(batch(("a", 1), ("b", 1)), 0)
    sink(batch(("a", 2), ("c", 2)), 1)
    wanted = [("a", 2), ("b", 1), ("c", 2)]
    assert rows(st.read_upserted(spark, path, ["k"])) == wanted
    sink(batch(("a", 2), ("c", 2)), 1)  # the engine repeats a batch
    assert rows(st.read_upserted(spark, path, ["k"])) == wanted
    st.upsert_sink(path, "other")(batch(("b", 9)), 0)  # another stream into the same table
    assert rows(st.read_upserted(spark, path, ["k"])) == [("a", 2), ("b", 9), ("c", 2)]


def test_upsert_goes_by_batch_whatever_the_clock(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    for batch_id, v, written in [(0, 1, "2025-10-01 09:00:00"), (1, 2, "2025-10-01 08:00:00")]:
        batch = spark.createDataFrame([("a", v)], "k string, v int")
        st.append_sink(path)(batch.withColumn("_written_at", F.lit(written).cast("timestamp")), batch_id)
    assert rows(st.read_upserted(spark, path, ["k"])) == [("a", 2)]
    assert rows(st.read_upserted(spark, path, [])) == [("a", 2)]


def test_end_of_input_closes_every_window_and_adds_none(spark, topic):
    topic.send((at("08:00:01"), 1, 1.0), (at("08:04:59"), None, 1.0))
    topic.send((at("08:20:00"), 2, 1.0), ("never", 2, 1.0))
    end = st.end_of_input(st.read_topic(spark, MESSAGE, path=str(topic.root)), "at", "5 minutes").first()
    assert (end.at, end.zone, end.tip) == (at("08:25:06"), None, None)
    topic.send(tuple(end))
    counts = st.tumbling(topic.stream(spark), "event_time", "5 minutes", ["zone"])
    st.run(counts, st.upsert_sink(topic.out), topic.checkpoint)
    got = _counts_nulls(st.read_upserted(spark, topic.out, ["window_start", "zone"]))
    assert got == {("08:00", 1, 1), ("08:00", None, 1), ("08:20", 2, 1)}
    nothing = spark.createDataFrame([("never", 1, 1.0)], MESSAGE)
    assert st.end_of_input(nothing, "at", "5 minutes").count() == 0


def _counts_nulls(df):
    return {(r.window_start.strftime("%H:%M"), r.zone, r.num_trips) for r in df.collect()}


def test_repeated_append_batch_does_not_double(spark, tmp_path):
    sink = st.append_sink(str(tmp_path / "table"))
    for batch_id in (0, 1, 1):
        sink(spark.range(3), batch_id)
    assert st.read_appended(spark, str(tmp_path / "table")).count() == 6


def test_running_counts(spark, topic):
    topic.send((at("08:00:01"), 1, 5.0), (at("08:00:01"), 1, 5.1), (at("08:00:01"), 1, None))
    topic.send((at("08:00:01"), 1, 7.0), (at("08:00:01"), 1, float("nan")))
    stream = st.stream_trips(spark, MESSAGE, path=str(topic.root), max_files=1)
    counts = st.running_counts(stream, X.greater_than("tip", 5.0))
    st.run(counts, st.upsert_sink(topic.out), topic.checkpoint, "complete")
    assert tuple(st.read_upserted(spark, topic.out, []).first()) == (5, 2)


def test_continuous_trigger(spark, topic):
    topic.send((at("08:00:01"), 1, 1.0), (at("08:10:00"), 1, 1.0))
    counts = st.tumbling(topic.stream(spark), "event_time", "5 minutes", ["zone"])
    query = st.run(counts, st.append_sink(topic.out), topic.checkpoint, every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert _counts(st.read_appended(spark, topic.out)) == [("08:00", 1, 1)]


# ---- what a stopped stream still holds -----------------------------------------------------------


def test_emitted_and_held_are_complete_and_the_topic_stays(spark, topic, rows):
    topic.send((at("08:00:01"), 1, 1.0), (at("08:04:59"), None, 2.0), ("never", 2, 1.0))
    topic.send((at("08:20:00"), 2, 4.0), (at("08:21:00"), None, 8.0))
    before = sorted(p.name for p in topic.root.iterdir())
    aggs = {"n": ("count", None), "tips": ("sum", "tip"), "low": ("min", "tip"), "all_tips": ("sum", "tip")}
    counts = st.tumbling(topic.stream(spark), "event_time", "5 minutes", ["zone"], aggs)
    st.run(counts, st.append_sink(topic.out), topic.checkpoint)
    held = st.held_windows(spark, topic.checkpoint, ["zone"], aggs)
    assert held.count() == 2
    whole = st.read_appended(spark, topic.out).unionByName(held)
    batch = st.with_event_time(st.read_topic(spark, MESSAGE, path=str(topic.root)), "at")
    wanted = st.tumbling(batch.filter("event_time IS NOT NULL"), "event_time", "5 minutes", ["zone"], aggs)
    zone_free = whole.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    assert rows(zone_free.select(*wanted.columns)) == rows(wanted)
    assert sorted(p.name for p in topic.root.iterdir()) == before
    # The stream goes on from its checkpoint, and emits what was held.
    topic.send((at("08:40:00"), 1, 1.0))
    st.run(st.tumbling(topic.stream(spark), "event_time", "5 minutes", ["zone"], aggs), st.append_sink(topic.out), topic.checkpoint)
    assert st.read_appended(spark, topic.out).count() == 4
    with pytest.raises(ValueError):
        st.held_windows(spark, topic.checkpoint, ["zone"]).count()


def test_held_sessions(spark, topic):
    topic.send((at("08:00:00"), 1, 1.0), (at("08:30:00"), None, 2.0), (at("08:33:00"), None, 3.0))
    aggs = {"n": ("count", None), "tips": ("sum", "tip")}
    found = st.sessions(topic.stream(spark), "event_time", "5 minutes", ["zone"], aggs)
    st.run(found, st.append_sink(topic.out), topic.checkpoint)
    held = st.held_sessions(spark, topic.checkpoint, ["zone"], aggs)
    got = [(r.session_start.strftime("%H:%M"), r.session_end.strftime("%H:%M"), r.zone, r.n, r.tips) for r in held.collect()]
    assert got == [("08:30", "08:38", None, 2, 5.0)]


# ---- late rows and dead letters ------------------------------------------------------------------


def test_late_and_unreadable_rows_are_told_apart(spark, topic):
    topic.send((at("08:00:01"), 1, 1.0), (at("08:30:00"), 1, 1.0))
    topic.send((at("08:31:00"), 1, 1.0), ("never", 1, 1.0))
    topic.send((at("08:03:00"), 1, 1.0), (at("08:03:10"), 1, 1.0), (at("08:04:00"), 2, 1.0))  # late: two groups

    def go(log):
        seen = st.observed(topic.stream(spark), F.col("event_time").isNull())
        st.run(st.tumbling(seen, "event_time", "5 minutes", ["zone"]), st.append_sink(topic.out), topic.checkpoint, log=log)
        return st.read_appended(spark, topic.out).unionByName(st.held_windows(spark, topic.checkpoint, ["zone"]))

    first = st.ProgressLog()
    windows = go(first)
    assert (first.total("read_rows"), first.total("unreadable_rows"), first.total("late_groups")) == (7, 1, 2)
    assert st.late_rows(first, windows) == 3
    # A restart without new rows adds nothing; one with a late row adds that.
    second = st.ProgressLog()
    topic.send((at("08:01:00"), 9, 1.0))
    both = st.ProgressLog.of([first, second])
    windows = go(second)
    both = st.ProgressLog.of([first, second])
    assert st.late_rows(both, windows) == 4
    report = both.rows(spark)
    assert report.count() == len(both.batches) and report.filter("late_groups > 0").count() == 2


def test_dead_letters(spark, tmp_path, rows):
    (tmp_path / "topic").mkdir()
    lines = ['{"at": "x", "zone": 1, "tip": 6.0}', '{"at": "x", "zo', '{"at": "x", "zone": 1, "tip": "far"}', "7", '{"zone": null}']
    (tmp_path / "topic" / "a.json").write_text("".join(f"{line}\n" for line in lines))
    good, dead = str(tmp_path / "good"), str(tmp_path / "dead")
    stream = st.stream_trips(spark, MESSAGE, path=str(tmp_path / "topic"), corrupt="unread")
    st.run(stream, st.dead_letter_sink(st.append_sink(good), st.append_sink(dead), "unread"), str(tmp_path / "c"))
    assert rows(st.read_appended(spark, good)) == rows(spark.createDataFrame([("x", 1, 6.0), (None, None, None)], MESSAGE))
    assert sorted(r.message for r in st.read_appended(spark, dead).collect()) == sorted(lines[1:4])
    batch = st.read_topic(spark, MESSAGE, path=str(tmp_path / "topic"), corrupt="unread")
    counted = st.running_counts(batch, X.greater_than("tip", 5.0), corrupt="unread").first()
    assert tuple(counted) == (2, 1, 3)


# ---- compaction ----------------------------------------------------------------------------------


def _files(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)


def test_compaction_keeps_rows_and_bounds_files(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    sink = st.upsert_sink(path, files=1, compact_every=4, keys=["k"])
    most = 0
    for n in range(30):
        sink(spark.createDataFrame([("a", n), (f"k{n % 7}", n)], "k string, v int"), n)
        most = max(most, _files(path))
    # Two bases of one file each, and the batches since the switch before the last.
    assert most <= 2 + 2 * 4
    wanted = [("a", 29)] + [(f"k{i}", max(n for n in range(30) if n % 7 == i)) for i in range(7)]
    assert rows(st.read_upserted(spark, path, ["k"])) == sorted(wanted)
    st.compact(spark, path, ["k"], files=1)
    base = spark.read.parquet(st.current_base(spark, path))
    assert rows(base.select("k", "v")) == sorted(wanted)
    assert st.compact(spark, path, ["k"]) == st.newest_version(spark, path)  # nothing new, nothing done


def test_a_compaction_killed_half_way_changes_nothing(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "table")
    sink = st.upsert_sink(path)

    def batch(n, *data):
        sink(spark.createDataFrame(data, "k string, v int"), n)

    batch(0, ("a", 1), ("b", 1))
    st.compact(spark, path, ["k"])
    batch(1, ("a", 2))
    wanted = [("a", 2), ("b", 1)]

    def killed(*_):
        raise RuntimeError("killed")

    # Before the switch: the new base is there, but nobody reads it.
    with monkeypatch.context() as m:
        m.setattr(st.compaction, "create_new", killed)
        with pytest.raises(RuntimeError):
            st.compact(spark, path, ["k"])
    assert st.newest_version(spark, path).number == 1
    assert rows(st.read_upserted(spark, path, ["k"])) == wanted
    # While the mark is written: an empty mark is none.
    with monkeypatch.context() as m:
        m.setattr(st.compaction, "create_new", lambda spark, where, text: (create_new(spark, where, ""), killed()))
        with pytest.raises(RuntimeError):
            st.compact(spark, path, ["k"])
    assert st.newest_version(spark, path).number == 1
    assert rows(st.read_upserted(spark, path, ["k"])) == wanted
    # After the switch, before the cleaning.
    with monkeypatch.context() as m:
        m.setattr(st.compaction, "_clean", killed)
        with pytest.raises(RuntimeError):
            st.compact(spark, path, ["k"])
    assert st.newest_version(spark, path).number == 3
    assert rows(st.read_upserted(spark, path, ["k"])) == wanted
    batch(2, ("c", 3))
    st.compact(spark, path, ["k"])
    assert rows(spark.read.parquet(st.current_base(spark, path)).select("k", "v")) == [*wanted, ("c", 3)]
    left = sorted(p for p in os.listdir(f"{path}/_versions") if p.startswith("data-"))
    assert [name.split("-")[1] for name in left] == ["3", "4"]
    # The engine repeats a batch that was folded: it is not read twice, and an older one changes nothing.
    batch(1, ("a", 2))
    assert rows(st.read_upserted(spark, path, ["k"])) == [*wanted, ("c", 3)]


def test_readers_that_began_before_a_switch_go_on(spark, tmp_path):
    path = str(tmp_path / "table")
    sink = st.append_sink(path)
    for n in range(3):
        sink(spark.range(2), n)
    old = st.read_appended(spark, path)
    st.compact(spark, path)
    assert old.count() == 6 == st.read_appended(spark, path).count()
    sink(spark.range(2), 3)
    between = st.read_appended(spark, path)
    st.compact(spark, path)
    assert between.count() == 8 == st.read_appended(spark, path).count()


def test_two_compactions_at_a_time(spark, tmp_path, monkeypatch):
    """The second finds the mark taken and fails; the first one's base counts."""
    path = str(tmp_path / "table")
    st.append_sink(path)(spark.range(3), 0)

    def late(spark, where, text):
        with monkeypatch.context() as m:
            m.setattr(st.compaction, "create_new", create_new)
            st.compact(spark, path)
        create_new(spark, where, text)

    with monkeypatch.context() as m:
        m.setattr(st.compaction, "create_new", late)
        with pytest.raises(Exception, match="already exists"):
            st.compact(spark, path)
    assert st.read_appended(spark, path).count() == 3
    assert spark.read.parquet(st.current_base(spark, path)).count() == 3
