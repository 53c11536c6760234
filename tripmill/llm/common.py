"""Helpers shared by the operators of this subpackage: intermediate tables, text hashing, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

#: The C library's way to return free memory, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

_U = np.uint64
# Fixed odd multipliers of the text hashes.
_BYTE_STEP = 0x9E3779B97F4A7C15
_BYTE_BACK = pow(_BYTE_STEP, -1, 1 << 64)
_WORD_STEP = _U(0xD6E8FEB86659FD93)
_PIECE = 1 << 18
#: Bytes of rows that tasks hand to Python at a time, in place of Spark's own bound of 64 MB.
BATCH_BYTES = 8 << 20


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def release() -> None:
    """Give freed memory back to the system: workers wait for their next task, and several share an executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean(work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` on a task's batches, after which its worker holds no more than it needs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release()

    return run


# ---- text hashing in numpy -------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[:1] = 1
    return np.multiply.accumulate(out)


_FORWARD = _powers(_BYTE_STEP, 1 << 16)
_BACKWARD = _powers(_BYTE_BACK, 1 << 16)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_BLANK[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word; equal words, equal hashes. ``data`` is already case-folded.

    Sums of byte times power are taken over the whole buffer at once; a word's part is a difference
    of two sums, brought back to power zero of its own start. Powers repeat every 65,536 bytes, so
    longer words are hashed one at a time.
    """
    n, period = len(data), len(_FORWARD)
    if not len(starts):
        return np.zeros(0, dtype=_U)
    sums = np.zeros(n + 1, dtype=_U)
    weights = np.resize(_FORWARD, n) if n > period else _FORWARD[:n]
    np.cumsum((data.astype(_U) + _U(1)) * weights, out=sums[1:])
    size = ends - starts
    where = starts % period
    out = (sums[ends] - sums[starts]) * _BACKWARD[where]
    wraps = np.flatnonzero(where + size > period)
    for i in wraps:
        word = data[starts[i]:ends[i]].astype(_U) + _U(1)
        out[i] = (word * _powers(_BYTE_STEP, len(word))).sum(dtype=_U)
    return mix64(out + size.astype(_U) * _WORD_STEP)


def texts_in_pieces(column: pa.Array, limit: int = _PIECE) -> Iterable[tuple[int, int, bytes, np.ndarray]]:
    """Whole texts of an Arrow column in runs of about ``limit`` bytes.

    Yields (first row, row after the last, bytes, offsets); a null text is empty. A longer text is
    a run of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = memoryview(data) if data is not None else memoryview(b"")
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, end, bytes(data[offsets[row]:offsets[end]]), offsets[row:end + 1] - offsets[row]
        row = end


def folded_words(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, row of the word, first word of each row and the end) of the texts of one run.

    Adjacent texts are parted by a blank before words are found, so that words never run together.
    """
    n = len(offsets) - 1
    size = np.diff(offsets)
    data = np.full(len(raw) + n, 32, dtype=np.uint8)
    if len(raw):
        keep = np.arange(len(raw)) + np.repeat(np.arange(n), size)
        data[keep] = _FOLD[np.frombuffer(raw, dtype=np.uint8)]
    starts, ends = word_spans(data)
    hashes = word_hashes(data, starts, ends)
    bounds = offsets[1:] + np.arange(1, n + 1)
    rows = np.searchsorted(bounds, starts, side="right")
    first = np.searchsorted(starts, np.concatenate([[0], bounds]))
    return hashes, rows, first


# ---- connected components -------------------------------------------------------------------

def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge (a, b); the component is its smallest node.

    Large-star and small-star rounds: every round hangs each node under the smallest one it has
    seen, by joins and grouped minima alone, so neither a hub nor a component is ever gathered in
    one place. Edges are cut from their lineage after each round. No edges give no rows.
    """
    u, v = F.col("u"), F.col("v")
    current = (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(u != v).distinct().checkpoint()
    )

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = state(current)
    while seen[0]:
        both = current.unionByName(current.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(v > u).join(low, "u").select(v.alias("u"), F.col("m").alias("v"))
            .where(u != v)
        )
        large = large.unionByName(low.select("u", F.col("m").alias("v")).where(u != v)).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(v.alias("u"), F.col("m").alias("v")).where(u != v)
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        current = small.checkpoint()
        now = state(current)
        if now == seen:
            break
        seen = now
    roots = current.select(v.alias("node"), v.alias("component")).distinct()
    return current.select(u.alias("node"), v.alias("component")).unionByName(roots)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns and no others, so that extra columns can't clash with an operator's own.

    Also bounds the batches that tasks hand to Python, where the session leaves Spark's bound.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) in ("67108864b", "64m", "64MB"):
        conf.set(name, f"{BATCH_BYTES}b")
    return df.select(*[df[c] for c in columns])
