"""What the batches of a stream have read, found unreadable and dropped as late."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

_ROWS = "batch_id bigint, read_rows bigint, unreadable_rows bigint, late_groups bigint, watermark string"
_OBSERVED = "readable"


def observed(timed: DataFrame, unreadable: Column) -> DataFrame:
    """The stream, with its rows and its unreadable rows counted on their way, batch by batch."""
    return timed.observe(
        _OBSERVED, F.count(F.lit(1)).alias("rows"), F.count_if(unreadable).alias("unreadable")
    )


class ProgressLog(StreamingQueryListener):
    """Batches of the streams that it is given to, by the engine's own progress reports.

    A batch is counted once, however often it is reported, in this run or after a restart (``of``). Reports
    of all batches are kept, a few numbers each.
    """

    def __init__(self):
        self.batches: dict[tuple[str, int], tuple] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()
        self._spark: SparkSession | None = None

    @classmethod
    def of(cls, logs: list[ProgressLog]) -> ProgressLog:
        """What several logs hold together; a batch that two of them have counts once."""
        whole = cls()
        for log in logs:
            whole.batches |= log.batches
        return whole

    def listen(self, spark: SparkSession) -> None:
        if self._spark is None:
            self._spark = spark
            spark.streams.addListener(self)

    def close(self, query: StreamingQuery, patience: float = 60.0) -> None:
        """Wait for the last report of a stream that has ended, and listen no longer."""
        with self._news:
            told = self._news.wait_for(lambda: str(query.runId) in self._ended, patience)
        if self._spark is not None:
            self._spark.streams.removeListener(self)
            self._spark = None
        if not told:
            raise TimeoutError(f"no report of the end of stream {query.runId} in {patience} s")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(_OBSERVED)
        late = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        # A batch without new data has no rows to observe, but is reported under a number of its own.
        row = (p.batchId, seen["rows"] if seen else 0, seen["unreadable"] if seen else 0, late, p.eventTime.get("watermark"))
        with self._news:
            self.batches[str(p.id), p.batchId] = row

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def rows(self, spark: SparkSession) -> DataFrame:
        """A row per batch: batch_id, read_rows, unreadable_rows, late_groups, watermark.

        ``late_groups`` counts groups (a window and its key) of a batch that had left before: what
        the engine drops is already aggregated.
        """
        return spark.createDataFrame(sorted(self.batches.values()), _ROWS)

    def total(self, name: str) -> int:
        at = [part.split()[0] for part in _ROWS.split(", ")].index(name)
        return sum(row[at] for row in self.batches.values())


def late_rows(log: ProgressLog, windows: DataFrame, counts: str = "num_trips") -> int:
    """Rows that came too late: read and readable, but in none of ``windows``, emitted and held together."""
    counted = windows.agg(F.sum(counts)).first()[0] or 0
    return log.total("read_rows") - log.total("unreadable_rows") - counted
