"""Streams of JSON messages, from a topic or from a folder of JSON lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.aggregates import counts_where
from tripmill.operators.projections import from_message
from tripmill.schemas import TRIP_MESSAGE


def stream_trips(
    spark: SparkSession,
    schema: T.StructType = TRIP_MESSAGE,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    max_files: int | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """An unbounded frame with the declared columns, read from the earliest message on.

    ``kafka`` holds the connector's options (bootstrap servers, subscribe, …). ``path`` is a folder
    of JSON lines; ``max_files`` bounds one micro-batch. ``corrupt`` asks for one more column of that
    name: the text of a message that is no JSON object or has a value of another type, else NULL. Without
    it such a message is a row of NULLs.
    """
    if kafka:
        options = {"startingOffsets": "earliest", **kafka}
        return from_message(spark.readStream.format("kafka").options(**options).load(), schema, corrupt=corrupt)
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if corrupt:
        return from_message(reader.text(path), schema, corrupt=corrupt)
    return reader.schema(schema).json(path)


def read_topic(
    spark: SparkSession,
    schema: T.StructType = TRIP_MESSAGE,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """All messages there are now, as a batch; ``corrupt`` as in ``stream_trips``."""
    if kafka:
        options = {"startingOffsets": "earliest", "endingOffsets": "latest", **kafka}
        return from_message(spark.read.format("kafka").options(**options).load(), schema, corrupt=corrupt)
    if corrupt:
        return from_message(spark.read.text(path), schema, corrupt=corrupt)
    return spark.read.schema(schema).json(path)


def running_counts(stream: DataFrame, cond: Column, corrupt: str | None = None) -> DataFrame:
    """Messages so far and matching messages so far; run it with output mode ``complete``.

    With ``corrupt``, the column that ``stream_trips`` was asked for: good_rows, matching_rows among them
    and unreadable_rows. An unreadable message matches nothing, whatever could be read of it.
    """
    if corrupt is None:
        return counts_where(stream, cond)
    good = F.col(corrupt).isNull()
    return stream.agg(
        F.count_if(good).alias("good_rows"),
        F.count_if(good & cond).alias("matching_rows"),
        F.count_if(~good).alias("unreadable_rows"),
    )
