"""Sinks that survive a repeated micro-batch.

Every batch owns one folder, ``stream=<name>/batch_id=<n>``, and overwrites it when the engine runs the
batch again. Nothing written by an earlier batch is touched, so a lost executor or driver can neither
double nor lose rows. Several streams may share a table under different names. A stream that starts over
with a new checkpoint counts its batches from zero again and so needs a new name.

Folders of batches are folded into a base by ``compaction.compact``, or by the sink itself every so many
batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill.session import prefer
from tripmill.streaming.compaction import WRITTEN, compact, read_table
from tripmill.streaming.progress import ProgressLog

BatchSink = Callable[[DataFrame, int], None]


def append_sink(
    path: str, stream: str = "main", files: int | None = None, compact_every: int | None = None
) -> BatchSink:
    """Each row once, without a key.

    A batch has a file per task of its last shuffle; ``files`` asks for fewer where batches are small.
    With ``compact_every`` n, every n-th batch first folds those before it into a base, which bounds the
    number of files however long the stream runs.
    """
    return _sink(path, stream, files, compact_every, None)


def _sink(
    path: str, stream: str, files: int | None, compact_every: int | None, keys: Sequence[str] | None
) -> BatchSink:
    def write(batch: DataFrame, batch_id: int) -> None:
        if compact_every and batch_id and batch_id % compact_every == 0:
            compact(batch.sparkSession, path, keys)
        rows = batch if keys is None else batch.withColumn(WRITTEN, F.current_timestamp())
        rows = rows.repartition(files) if files else rows
        rows.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch_id={batch_id}")

    return write


def upsert_sink(
    path: str,
    stream: str = "main",
    files: int | None = None,
    compact_every: int | None = None,
    keys: Sequence[str] = (),
) -> BatchSink:
    """A later row replaces an earlier one with the same key, which ``read_upserted`` resolves.

    A batch costs what the batch holds, whatever the size of the table. ``keys`` are needed for
    ``compact_every`` alone, see ``append_sink``.
    """
    return _sink(path, stream, files, compact_every, list(keys))


def dead_letter_sink(good: BatchSink, rejects: BatchSink, corrupt: str) -> BatchSink:
    """Rows whose column ``corrupt`` holds the text of an unreadable message go to ``rejects``, the others to ``good``.

    ``corrupt`` names the column that ``stream_trips`` was asked for. Both outputs are repeat-safe, so the pair is.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        unreadable = F.col(corrupt).isNotNull()
        good(batch.filter(~unreadable).drop(corrupt), batch_id)
        rejects(batch.filter(unreadable).select(F.col(corrupt).alias("message")), batch_id)

    return write


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key. Without keys the table has one row, the newest of all.

    Within a stream a later batch is newer, whatever clock its driver had; between streams the time
    of writing decides. Each task keeps one row per key and stream before the shuffle
    (WindowGroupLimit, or a top-1 without keys).
    """
    return read_table(spark, path, list(keys))


def run(
    stream: DataFrame,
    sink: BatchSink | str,
    checkpoint: str,
    output_mode: str = "append",
    every: str | None = None,
    log: ProgressLog | None = None,
) -> StreamingQuery:
    """Start the stream. Without ``every`` it takes all input there is and stops by itself.

    A path as ``sink`` is Spark's own Parquet sink, which also writes each row once and is read with
    ``spark.read.parquet``; it knows append mode only. In append mode a window leaves once, when the
    watermark has passed its end; rows later than that are dropped. ``checkpoint`` is a shared folder
    and stands for the consumer's position. Settings that the session leaves open are set as the
    package prefers, among them the merge of sessions before the shuffle. ``log`` collects what each
    batch has read and dropped.
    """
    prefer(stream.sparkSession)
    if log:
        log.listen(stream.sparkSession)
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if isinstance(sink, str):
        writer = writer.format("parquet").option("path", sink)
    else:
        writer = writer.foreachBatch(sink)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if log:
        log.close(query)
    return query
