"""What a stopped stream still holds: windows and sessions that its watermark has not closed.

The engine's own reader of a checkpoint's state gives them, so the topic gets no message that ends it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.streaming.eventtime import TRIPS, Aggs


def _state(spark: SparkSession, checkpoint: str, lead: int, aggs: Aggs) -> DataFrame:
    """The state's rows (key, value); after ``lead`` fields the value has one per distinct aggregate, named ``_0``, ``_1``, …"""
    state = spark.read.format("statestore").load(checkpoint)
    fields = state.schema["value"].dataType.fields
    n = len(set(aggs.values()))
    if len(fields) != lead + n:
        raise ValueError(f"the stream of {checkpoint} keeps {[f.name for f in fields]}, which does not fit {dict(aggs)}")
    # The engine's own names may repeat.
    names = [*(f"_lead{i}" for i in range(lead)), *(f"_{i}" for i in range(n))]
    named = T.StructType([T.StructField(name, f.dataType) for name, f in zip(names, fields)])
    return state.withColumn("value", F.col("value").cast(named))


def _values(aggs: Aggs) -> list[Column]:
    """Equal aggregates under several names are kept once."""
    kept = list(dict.fromkeys(aggs.values()))
    return [F.col(f"value._{kept.index(agg)}").alias(name) for name, agg in aggs.items()]


def held_windows(
    spark: SparkSession, checkpoint: str, keys: Sequence[str] = (), aggs: Aggs = TRIPS
) -> DataFrame:
    """Windows of ``tumbling`` that a stream in append mode has not emitted yet, in its columns.

    ``checkpoint`` is that of the stopped stream, ``keys`` and ``aggs`` as ``tumbling`` got them. With
    the emitted windows they are complete; the stream may go on from the checkpoint afterwards.
    """
    state = _state(spark, checkpoint, 0, aggs)
    return state.select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        *[F.col(f"key.{k}").alias(k) for k in keys],
        *_values(aggs),
    )


def held_sessions(
    spark: SparkSession, checkpoint: str, keys: Sequence[str], aggs: Aggs = TRIPS
) -> DataFrame:
    """Sessions of ``sessions`` that a stream in append mode has not emitted yet, in its columns."""
    state = _state(spark, checkpoint, 1 + len(keys), aggs)
    return state.select(
        F.col("value._lead0.start").alias("session_start"),
        F.col("value._lead0.end").alias("session_end"),
        *[F.col(f"key.{k}").alias(k) for k in keys],
        *_values(aggs),
    )
