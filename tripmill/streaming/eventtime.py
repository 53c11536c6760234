"""Event time, tumbling windows and sessions; each works on a batch and on a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import MESSAGE_TIME, parse_time

# An aggregate is named by its kind and its column; a count needs none.
Aggs = Mapping[str, tuple[str, str | None]]

_KINDS = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
# How results of parts of a group are put together.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}

TRIPS: Aggs = {"num_trips": ("count", None)}


def _expressions(aggs: Aggs) -> list[Column]:
    return [
        _KINDS[kind](F.lit(1) if c is None else F.col(c)).alias(name)
        for name, (kind, c) in aggs.items()
    ]


def with_event_time(
    df: DataFrame,
    c: str,
    fmt: str = MESSAGE_TIME,
    delay: str = "5 seconds",
    name: str = "event_time",
) -> DataFrame:
    """Event time parsed from text, with a watermark ``delay`` behind the newest if ``df`` is a stream.

    A stream needs a zoned timestamp; a batch gets the zone-free kind.
    """
    timed = df.withColumn(name, parse_time(c, fmt, zone_free=not df.isStreaming))
    return timed.withWatermark(name, delay) if df.isStreaming else timed


def unparsed_times(df: DataFrame, c: str, fmt: str = MESSAGE_TIME) -> DataFrame:
    """Rows whose time is missing or does not parse; windows leave these out."""
    return df.filter(parse_time(c, fmt).isNull())


def tumbling(
    df: DataFrame,
    time: str,
    size: str,
    keys: Sequence[str] = (),
    aggs: Aggs = TRIPS,
) -> DataFrame:
    """Aggregates per window of fixed ``size`` and key: window_start, window_end, keys, aggregates."""
    return (
        df.groupBy(F.window(time, size).alias("_w"), *keys)
        .agg(*_expressions(aggs))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *keys,
            *aggs,
        )
    )


def sessions(
    df: DataFrame,
    time: str,
    gap: str,
    keys: Sequence[str],
    aggs: Aggs = TRIPS,
) -> DataFrame:
    """Aggregates per session and key: session_start, session_end, keys, aggregates.

    Rows of a key belong to one session while each follows the last within ``gap``, a distance of
    exactly ``gap`` included. The end is the last row's time plus ``gap``. Keys are required.
    """
    if not keys:
        raise ValueError("sessions need at least one key")
    if df.isStreaming:
        return (
            df.groupBy(F.session_window(time, gap).alias("_s"), *keys)
            .agg(*_expressions(aggs))
            .select(
                F.col("_s.start").alias("session_start"),
                F.col("_s.end").alias("session_end"),
                *keys,
                *aggs,
            )
        )
    return _batch_sessions(df, time, gap, keys, aggs)


#: Cells of a span: what one task orders of a key is one span, or what spans leave over.
SPAN_CELLS = 4096


def _micros(time: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time.cast("timestamp_ntz"))


def _numbered(rows: DataFrame, within: Sequence[str], first: str, last: str, wait: Column, name: str) -> DataFrame:
    """Rows with the number of their session among those of ``within``, in order of ``first``."""
    ordered = Window.partitionBy(*within).orderBy(first)
    before = F.lag(last).over(ordered)
    opens = F.when(before.isNull() | (F.col(first) > before + wait), 1).otherwise(0)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_opens", opens).withColumn(name, F.sum("_opens").over(so_far)).drop("_opens")


def _batch_sessions(
    df: DataFrame, time: str, gap: str, keys: Sequence[str], aggs: Aggs, span_cells: int = SPAN_CELLS
) -> DataFrame:
    """Sessions by way of cells and spans, so that a hot key is never one task's rows.

    Rows of one key in one cell of width ``gap`` are less than ``gap`` apart and so always share a
    session; they are aggregated per cell in the scanning tasks. Cells are then strung to sessions in
    spans of ``span_cells`` cells, each span by itself. Only the first and the last session of a span can
    go on in another one: these alone are strung per key, at most two rows per span, while every other
    session is final and stands alone.
    """
    wait = F.expr(f"INTERVAL {gap}")
    cells = df.groupBy(*keys, F.window(time, gap).alias("_cell")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), *_expressions(aggs)
    )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    width = _micros(epoch + wait) * span_cells
    cells = cells.withColumn("_span", F.floor(_micros(F.col("_cell.start")) / width)).drop("_cell")
    in_span = [*keys, "_span"]
    strung = _numbered(cells, in_span, "_first", "_last", wait, "_session")
    strung = strung.withColumn("_latest", F.max("_session").over(Window.partitionBy(*in_span)))
    parts = strung.groupBy(*in_span, "_session").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        (F.first("_session") == F.first("_latest")).alias("_ends"),
        *[_MERGE[kind](name).alias(name) for name, (kind, _) in aggs.items()],
    )
    # What can go on elsewhere shares one group per key; the others have one each.
    edge = (F.col("_session") == 1) | F.col("_ends")
    parts = parts.withColumn("_alone", F.when(~edge, F.struct("_span", "_session")))
    chained = _numbered(parts, [*keys, "_alone"], "_first", "_last", wait, "_chain")
    return (
        chained.groupBy(*keys, "_alone", "_chain")
        .agg(
            F.min("_first").alias("session_start"),
            (F.max("_last") + wait).alias("session_end"),
            *[_MERGE[kind](name).alias(name) for name, (kind, _) in aggs.items()],
        )
        .select("session_start", "session_end", *keys, *aggs)
    )


def closed_windows(
    windows: DataFrame, rows: DataFrame, time: str, end: str, delay: str = "5 seconds"
) -> DataFrame:
    """Of batch results, those a stream over the same rows has emitted: ``end`` has passed the watermark.

    The rest is the tail a stream still holds, for callers who want complete results from a batch.
    """
    newest = rows.agg(F.max(time).alias("newest")).scalar()
    return windows.filter(F.col(end) <= newest - F.expr(f"INTERVAL {delay}"))


def end_of_input(
    messages: DataFrame, time: str, wait: str, delay: str = "5 seconds", fmt: str = MESSAGE_TIME
) -> DataFrame:
    """The message that completes a bounded input: published last, it closes every window before it.

    Its time lies ``wait`` (the size of windows or the gap of sessions), ``delay`` and one second after
    the newest of ``messages``; all other columns are NULL. Its own window or session never closes, so
    it is in no result. Rows that are sent after it are late. Without a readable time there is nothing
    to close and no message.
    """
    after = F.expr(f"INTERVAL {wait}") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 second")
    newest = messages.agg(F.max(parse_time(time, fmt)).alias("_newest")).filter("_newest IS NOT NULL")
    return newest.select(
        *[
            F.date_format(F.col("_newest") + after, fmt).alias(f.name)
            if f.name == time
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in messages.schema.fields
        ]
    )
