"""Streams over the events as JSON messages, each run to the end of its input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import functions as X
from tripmill import operators as op
from tripmill import sinks
from tripmill import streaming as st
from tripmill.plans.registry import query, table
from tripmill.plans.windows import hourly_sql, sessions_sql, tumbling_sql
from tripmill.session import shared_dir

_MESSAGE = T.StructType(
    [
        T.StructField("ts", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
# Messages carry seconds; what the watermark has not passed stays in the stream.
_SECONDS = "(SELECT event_id, date_trunc('second', ts) AS ts, event_type, value FROM events)"
_CLOSED = "<= (SELECT max(date_trunc('second', ts)) - INTERVAL 5 second FROM events)"


def _published(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "messages")
    messages = op.to_message(
        table(spark, sf_dir, "events"), times=["ts"], texts=["event_type"], doubles=["value"]
    )
    sinks.publish_json(messages, path)
    return path


def _timed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = st.stream_trips(spark, _MESSAGE, path=_published(spark, sf_dir))
    return st.with_event_time(stream, "ts")


def _zone_free(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(f"SELECT * FROM ({tumbling_sql(_SECONDS)}) WHERE window_end {_CLOSED}")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "window-counts")
    counts = st.tumbling(_timed_stream(spark, sf_dir), "event_time", "5 minutes", ["event_type"])
    st.run(counts, st.upsert_sink(out), shared_dir(spark, "checkpoint"))
    rows = st.read_upserted(spark, out, ["window_start", "event_type"])
    return _zone_free(rows, "window_start", "window_end")


@query(f"SELECT * FROM ({sessions_sql(_SECONDS)}) WHERE session_end {_CLOSED}")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "sessions")
    found = st.sessions(_timed_stream(spark, sf_dir), "event_time", "5 minutes", ["event_type"])
    st.run(found, st.append_sink(out), shared_dir(spark, "checkpoint"))
    return _zone_free(st.read_appended(spark, out), "session_start", "session_end")


@query(
    "SELECT window_start, window_end, round(total_tip_amount, 2) AS total_tip_amount "
    f"FROM ({hourly_sql(_SECONDS)}) WHERE window_end {_CLOSED}"
)
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "hourly")
    tips = st.tumbling(
        _timed_stream(spark, sf_dir),
        "event_time",
        "1 hour",
        aggs={"total_tip_amount": ("sum", "value")},
    )
    st.run(tips, out, shared_dir(spark, "checkpoint"))
    rows = _zone_free(spark.read.parquet(out), "window_start", "window_end")
    return rows.withColumn("total_tip_amount", F.round("total_tip_amount", 2))


@query("SELECT count(*) AS total_rows, count(*) FILTER (value > 5.0) AS matching_rows FROM events")
def publish_consume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of a consumer that stops when the topic is used up."""
    out = shared_dir(spark, "counts")
    stream = st.stream_trips(spark, _MESSAGE, path=_published(spark, sf_dir), max_files=1)
    counts = st.running_counts(stream, X.greater_than("value", 5.0))
    st.run(counts, st.upsert_sink(out), shared_dir(spark, "checkpoint"), "complete")
    return st.read_upserted(spark, out, [])


@query(
    f"SELECT * FROM ({tumbling_sql(_SECONDS)}) WHERE window_end {_CLOSED} "
    "ORDER BY num_trips DESC, window_start, event_type LIMIT 3"
)
def stream_busiest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over the table a stream keeps."""
    counts = stream_tumbling(spark, sf_dir)
    # Handed over as an argument: no view of a fixed name that another run could replace.
    return spark.sql(
        "SELECT * FROM {counts} ORDER BY num_trips DESC, window_start, event_type LIMIT 3", counts=counts
    )


@query(f"SELECT * FROM ({tumbling_sql(_SECONDS)}) WHERE window_end {_CLOSED}")
def closed_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``stream_tumbling`` emits, computed from the messages as a batch."""
    messages = st.read_topic(spark, _MESSAGE, path=_published(spark, sf_dir))
    timed = st.with_event_time(messages, "ts")
    counts = st.tumbling(timed, "event_time", "5 minutes", ["event_type"])
    return st.closed_windows(counts, timed, "event_time", "window_end")


# ---- complete results of a bounded stream: what it has emitted and what it still holds ----------


@query(tumbling_sql(_SECONDS))
def stream_tumbling_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window of a bounded stream, the last ones too."""
    out, checkpoint = shared_dir(spark, "window-counts"), shared_dir(spark, "checkpoint")
    keys = ["event_type"]
    counts = st.tumbling(_timed_stream(spark, sf_dir), "event_time", "5 minutes", keys)
    st.run(counts, st.upsert_sink(out), checkpoint)
    emitted = st.read_upserted(spark, out, ["window_start", *keys])
    rows = emitted.unionByName(st.held_windows(spark, checkpoint, keys))
    return _zone_free(rows, "window_start", "window_end")


@query(sessions_sql(_SECONDS))
def stream_session_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = shared_dir(spark, "sessions"), shared_dir(spark, "checkpoint")
    found = st.sessions(_timed_stream(spark, sf_dir), "event_time", "5 minutes", ["event_type"])
    st.run(found, st.append_sink(out), checkpoint)
    held = st.held_sessions(spark, checkpoint, ["event_type"])
    return _zone_free(st.read_appended(spark, out).unionByName(held), "session_start", "session_end")


@query(
    "SELECT window_start, window_end, round(total_tip_amount, 2) AS total_tip_amount "
    f"FROM ({hourly_sql(_SECONDS)})"
)
def stream_hourly_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = shared_dir(spark, "hourly"), shared_dir(spark, "checkpoint")
    aggs = {"total_tip_amount": ("sum", "value")}
    tips = st.tumbling(_timed_stream(spark, sf_dir), "event_time", "1 hour", aggs=aggs)
    st.run(tips, out, checkpoint)
    rows = spark.read.parquet(out).unionByName(st.held_windows(spark, checkpoint, aggs=aggs))
    rows = _zone_free(rows, "window_start", "window_end")
    return rows.withColumn("total_tip_amount", F.round("total_tip_amount", 2))


# ---- streams in several runs: the topic grows between them --------------------------------------

#: Events are published in parts of eight days of a month.
_PARTS = 4
_PART_SQL = "least((day(ts) - 1) // 8, 3)"
_PART = f"least(floor((dayofmonth(ts) - 1) / 8), {_PARTS - 1})"


def _publish(events: DataFrame, path: str, **kinds) -> None:
    sinks.publish_json(op.to_message(events, **kinds), path)


def _runs(spark: SparkSession, path: str, parts: list[DataFrame], run_once) -> None:
    """Publish a part, run the stream to the end of its input, and so on."""
    for number, part in enumerate(parts):
        _publish(part, path, texts=["ts", "event_type"], doubles=["value"])
        run_once(number)


def _texted(events: DataFrame) -> DataFrame:
    """Events with their time as messages carry it."""
    return events.withColumn("ts", F.date_format("ts", X.MESSAGE_TIME))


@query(tumbling_sql(_SECONDS))
def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that a stream updates over four runs, folded into a base after the second and the last.

    The result is the base alone, as any reader of Parquet sees it.
    """
    topic, out, checkpoint = (shared_dir(spark, n) for n in ("messages", "window-counts", "checkpoint"))
    keys = ["window_start", "event_type"]
    events = table(spark, sf_dir, "events").withColumn("part", F.expr(_PART))
    parts = [_texted(events.filter(F.col("part") == n)) for n in range(_PARTS)]

    def run_once(number: int) -> None:
        timed = st.with_event_time(st.stream_trips(spark, _MESSAGE, path=topic), "ts")
        counts = st.tumbling(timed, "event_time", "5 minutes", ["event_type"])
        st.run(counts, st.upsert_sink(out), checkpoint, "update")
        if number % 2:
            st.compact(spark, out, keys)

    _runs(spark, topic, parts, run_once)
    base = spark.read.parquet(st.current_base(spark, out))
    return _zone_free(base, "window_start", "window_end").select(
        "window_start", "window_end", "event_type", "num_trips"
    )


@query(tumbling_sql(_SECONDS))
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is stopped and goes on from its checkpoint three times, into Spark's own sink."""
    topic, out, checkpoint = (shared_dir(spark, n) for n in ("messages", "window-counts", "checkpoint"))
    events = table(spark, sf_dir, "events").withColumn("part", F.expr(_PART))
    parts = [_texted(events.filter(F.col("part") == n)) for n in range(_PARTS)]

    def run_once(_: int) -> None:
        timed = st.with_event_time(st.stream_trips(spark, _MESSAGE, path=topic), "ts")
        st.run(st.tumbling(timed, "event_time", "5 minutes", ["event_type"]), out, checkpoint)

    _runs(spark, topic, parts, run_once)
    rows = spark.read.parquet(out).unionByName(st.held_windows(spark, checkpoint, ["event_type"]))
    return _zone_free(rows, "window_start", "window_end")


_LATE, _UNREADABLE = 7, 11
_LATE_SQL = f"""
WITH told AS (
  SELECT date_trunc('second', ts) AS ts, event_type, {_PART_SQL} + CASE WHEN event_id % 50 = {_LATE} THEN 1 ELSE 0 END AS part,
         event_id % 50 = {_UNREADABLE} AS unreadable FROM events),
timed AS (
  SELECT *, time_bucket(INTERVAL 5 minute, ts) AS window_start FROM told WHERE NOT unreadable),
marks AS (
  SELECT p.part, (SELECT max(ts) - INTERVAL 5 second FROM timed t WHERE t.part < p.part) AS mark
  FROM (SELECT DISTINCT part FROM timed) p),
judged AS (
  SELECT timed.*, coalesce(window_start + INTERVAL 5 minute <= mark, false) AS late FROM timed JOIN marks USING (part))
SELECT window_start, window_start + INTERVAL 5 minute AS window_end, event_type, count(*) AS num_trips,
       (SELECT count(*) FROM judged WHERE late) AS late_rows,
       (SELECT count(*) FROM (SELECT DISTINCT part, window_start, event_type FROM judged WHERE late)) AS late_groups,
       (SELECT count(*) FROM told WHERE unreadable) AS unreadable_rows
FROM judged WHERE NOT late GROUP BY ALL
"""


@query(_LATE_SQL)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a stream in five runs, with what it has dropped as late and what it could not read.

    One event of fifty comes a run late, behind the watermark; of another the time is no time.
    """
    topic, out, checkpoint = (shared_dir(spark, n) for n in ("messages", "window-counts", "checkpoint"))
    slot = F.col("event_id") % 50
    events = _texted(table(spark, sf_dir, "events").withColumn("part", F.expr(_PART) + F.when(slot == _LATE, 1).otherwise(0)))
    events = events.withColumn("ts", F.when(slot == _UNREADABLE, F.lit("soon")).otherwise(F.col("ts")))
    parts = [events.filter(F.col("part") == n) for n in range(_PARTS + 1)]
    logs = []

    def run_once(number: int) -> None:
        timed = st.with_event_time(st.stream_trips(spark, _MESSAGE, path=topic), "ts")
        seen = st.observed(timed, F.col("event_time").isNull())
        log = st.ProgressLog()
        st.run(st.tumbling(seen, "event_time", "5 minutes", ["event_type"]), st.append_sink(out), checkpoint, log=log)
        logs.append(log)

    _runs(spark, topic, parts, run_once)
    windows = st.read_appended(spark, out).unionByName(st.held_windows(spark, checkpoint, ["event_type"]))
    log = st.ProgressLog.of(logs)
    dropped = {"late_rows": st.late_rows(log, windows), "late_groups": log.total("late_groups"),
               "unreadable_rows": log.total("unreadable_rows")}
    windows = windows.withColumns({name: F.lit(n).cast("bigint") for name, n in dropped.items()})
    return _zone_free(windows, "window_start", "window_end")


_BROKEN, _WORDY = 3, 8


@query(
    f"SELECT count(*) FILTER (NOT bad) AS good_rows, count(*) FILTER (NOT bad AND value > 5.0) AS matching_rows, "
    "count(*) FILTER (bad) AS unreadable_rows, count(*) FILTER (bad) AS dead_letters, "
    "round(sum(value) FILTER (NOT bad), 2) AS good_value "
    f"FROM (SELECT value, event_id % 10 IN ({_BROKEN}, {_WORDY}) AS bad FROM events)"
)
def consume_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer of messages of which some are cut off and some have a text for a number.

    One stream counts; another keeps good messages and dead letters in tables of their own.
    """
    topic = shared_dir(spark, "messages")
    slot = F.col("event_id") % 10
    whole = F.to_json(F.struct(F.date_format("ts", X.MESSAGE_TIME).alias("ts"), "event_type", "value"))
    wordy = F.to_json(F.struct(F.date_format("ts", X.MESSAGE_TIME).alias("ts"), "event_type", F.lit("far").alias("value")))
    message = F.when(slot == _BROKEN, F.substring(whole, 1, 20)).when(slot == _WORDY, wordy).otherwise(whole)
    sinks.publish_json(table(spark, sf_dir, "events").select(message.alias("value")), topic)

    def stream() -> DataFrame:
        return st.stream_trips(spark, _MESSAGE, path=topic, max_files=1, corrupt="unread")

    counts, good, dead = (shared_dir(spark, n) for n in ("counts", "good", "dead-letters"))
    running = st.running_counts(stream(), X.greater_than("value", 5.0), corrupt="unread")
    st.run(running, st.upsert_sink(counts), shared_dir(spark, "checkpoint"), "complete")
    apart = st.dead_letter_sink(st.append_sink(good), st.append_sink(dead), "unread")
    st.run(stream(), apart, shared_dir(spark, "checkpoint"))
    letters = st.read_appended(spark, dead).agg(F.count("message")).scalar()
    value = st.read_appended(spark, good).agg(F.round(F.sum("value"), 2)).scalar()
    return st.read_upserted(spark, counts, []).select("*", letters.alias("dead_letters"), value.alias("good_value"))
