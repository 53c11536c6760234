"""Line dedup that can be undone: sharded cuckoo filters over an exact reference-count table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import lean, mix64, require, shuffles, stash

MIN_LENGTH = 40
MIN_DOCS = 5
BLANKS = b" \t\n\x0b\x0c\r"
#: Slots per bucket and the most moves before a cuckoo filter is built anew with twice the buckets.
SLOTS, MOVES = 4, 500
#: Keys per shard that the number of shards is chosen for.
SHARD_KEYS = 1 << 17
#: Each shard's lines are dealt to so many tasks at least, so that a line of very many documents is spread.
SALTS = 16
#: Changes are folded into the postings when they are over this part of them.
FOLD = 4

_U = np.uint64


# ---- cuckoo filter --------------------------------------------------------------------------

class CuckooFilter:
    """Set of 64-bit keys by 16-bit fingerprints in two buckets each; supports removal.

    Never misses a key it holds. ``slots`` is an array of (buckets, SLOTS), 0 for a free one.
    """

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter of distinct keys, at most about 85 % full."""
        n = 1
        while n * SLOTS * 0.85 < len(keys):
            n *= 2
        while True:
            made = cls(np.zeros((n, SLOTS), dtype=np.uint16))
            if all(made.insert(k) for k in keys.astype(_U)):
                return made
            n *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = _U(len(self.slots) - 1)
        mixed = mix64(keys.astype(_U))
        mark = (mixed >> _U(48)).astype(np.uint16)
        mark = np.where(mark == 0, np.uint16(1), mark)
        first = mixed & mask
        return mark, first, self._other(first, mark)

    def _other(self, place, mark):
        return (place ^ mix64(np.asarray(mark).astype(_U))) & _U(len(self.slots) - 1)

    def insert(self, key) -> bool:
        mark, first, second = (x[0] for x in self._places(np.asarray([key], dtype=_U)))
        for place in (first, second):
            free = np.flatnonzero(self.slots[place] == 0)
            if len(free):
                self.slots[place, free[0]] = mark
                return True
        place = first
        for move in range(MOVES):
            slot = move % SLOTS
            mark, self.slots[place, slot] = self.slots[place, slot], mark
            place = self._other(place, mark)
            free = np.flatnonzero(self.slots[place] == 0)
            if len(free):
                self.slots[place, free[0]] = mark
                return True
        return False

    def remove(self, key) -> bool:
        """Forget one insertion of a key that was inserted."""
        mark, first, second = (x[0] for x in self._places(np.asarray([key], dtype=_U)))
        for place in (first, second):
            held = np.flatnonzero(self.slots[place] == mark)
            if len(held):
                self.slots[place, held[0]] = 0
                return True
        return False

    def holds(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, dtype=bool)
        mark, first, second = self._places(keys)
        return ((self.slots[first] == mark[:, None]) | (self.slots[second] == mark[:, None])).any(axis=1)

    def dump(self) -> bytes:
        return self.slots.tobytes()

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, dtype=np.uint16).reshape(-1, SLOTS).copy())


# ---- keys of lines --------------------------------------------------------------------------

def line_key(line: bytes, min_length: int) -> tuple[int, int] | None:
    """Two signed 64-bit halves of a digest of the stripped, folded line; None for a short one."""
    line = line.strip(BLANKS)
    if len(line) < min_length:
        return None
    if len(line) < 4 * min_length and len(line.decode("utf-8", "replace")) < min_length:
        return None
    digest = hashlib.blake2b(line.lower(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column.cast(pa.binary()):
        yield text.as_py() or b""


def line_postings(docs: DataFrame, min_length: int) -> DataFrame:
    """(h1, h2, doc_id), once for each long line's key and row of ``docs``."""

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, row = [], [], []
            for i, raw in enumerate(_texts(batch.column("text"))):
                own = {line_key(x, min_length) for x in raw.split(b"\n")}
                own.discard(None)
                h1 += [k[0] for k in own]
                h2 += [k[1] for k in own]
                row += [i] * len(own)
            ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), ids], ["h1", "h2", "doc_id"])

    return require(docs, ["doc_id", "text"]).mapInArrow(lean(keys), "h1 long, h2 long, doc_id long")


# ---- the index ------------------------------------------------------------------------------

def _shard(n: int) -> Column:
    return F.pmod(F.col("h1"), F.lit(n)).cast("int").alias("shard")


class LineIndex:
    """Which documents hold which line, kept exactly, and a cuckoo filter per shard of the repeated ones.

    ``base``: (h1, h2, doc_id), distinct: the exact table as it was when last folded.
    ``net``: (h1, h2, doc_id, step), what changed since: rows to add (step 1, not in the base) and to take away (-1, in the
    base). None for no change.
    ``refs``: (h1, h2, n_docs, top_doc) of keys in at least ``min_docs`` documents.
    ``filters``: (shard, filter), the refs' keys. All are tables in the shared folder; each
    change gives a new index and leaves the old one as it was, so a change can be undone.

    A change writes the postings of its own documents and counts again the keys that these touch, no others. The base
    is read for that, but written anew only when the changes are over a ``FOLD``-th of it; shards are dealt anew
    when they hold twice as many keys as they were made for.
    """

    def __init__(self, base, net, refs, filters, shards, min_docs, min_length):
        self.base, self.net, self.refs, self.filters = base, net, refs, filters
        self.shards, self.min_docs, self.min_length = shards, min_docs, min_length

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = MIN_DOCS, min_length: int = MIN_LENGTH) -> LineIndex:
        base = stash(line_postings(docs, min_length).distinct(), "line-postings")
        refs = stash(_counted(base, min_docs), "line-refs")
        shards = max(1, -(-refs.count() // SHARD_KEYS))
        return cls(base, None, refs, stash(_new_filters(refs, shards), "line-filters"), shards, min_docs, min_length)

    @property
    def postings(self) -> DataFrame:
        """(h1, h2, doc_id) of every document now in the index, distinct."""
        return _applied(self.base, self.net)

    def insert(self, docs: DataFrame) -> LineIndex:
        """With more documents. Lines that a document already has here count once."""
        more = stash(line_postings(docs, self.min_length).distinct(), "line-inserted")
        known = self.postings.join(more.select("h1").distinct(), "h1", "left_semi")
        return self._changed(_without(more, known).withColumn("step", F.lit(1)))

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Without the documents whose doc_id is in ``doc_ids``; what they held is as if never inserted."""
        gone = doc_ids.select(F.col("doc_id").alias("_gone")).distinct()
        held = self.postings.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_semi")
        return self._changed(held.withColumn("step", F.lit(-1)))

    def _changed(self, change: DataFrame) -> LineIndex:
        """The index after steps that each add a row it does not hold, or take away one that it holds."""
        change = stash(change.select("h1", "h2", "doc_id", "step"), "line-change")
        net = change
        if self.net is not None:  # a row taken away and added again is no change
            net = self.net.unionByName(change).groupBy("h1", "h2", "doc_id").agg(
                F.sum("step").cast("int").alias("step")).where("step <> 0")
            net = stash(net, "line-net")
        base = self.base
        if net.count() * FOLD > base.count():
            base, net = stash(_applied(base, net), "line-postings"), None
        touched = change.select("h1").distinct()
        counted = stash(_counted(_applied(base, net).join(touched, "h1", "left_semi"), self.min_docs), "line-recounted")
        refs = stash(self.refs.join(touched, "h1", "left_anti").unionByName(counted), "line-refs")
        shards, need = self.shards, -(-refs.count() // SHARD_KEYS)
        if need > 2 * shards:
            shards, filters = need, _new_filters(refs, need)
        else:
            filters = _changed_filters(self, refs, self.refs.join(touched, "h1", "left_semi"), counted)
        return LineIndex(base, net, refs, stash(filters, "line-filters"), shards, self.min_docs, self.min_length)

    def repeated(self, postings: DataFrame) -> DataFrame:
        """(doc_id, h1, h2) of the given lines that their document loses.

        A line is first held against its shard's filter, which streams into the task ahead of the
        lines; what passes is confirmed by a join with the exact counts.
        """
        n = self.shards
        salts = max(SALTS, -(-2 * shuffles(postings.sparkSession) // n))
        lines = postings.select(
            _shard(n), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
            F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("filter"), "h1", "h2", "doc_id")
        filters = self.filters.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"),
            "filter", *[F.lit(None).cast("long").alias(c) for c in ("h1", "h2", "doc_id")])
        dealt = lines.unionByName(filters).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
        passed = dealt.mapInArrow(lean(_probe), "h1 long, h2 long, doc_id long")
        return passed.join(self.refs, ["h1", "h2"]).where(
            F.col("doc_id").isNull() | (F.col("doc_id") < F.col("top_doc"))).select("doc_id", "h1", "h2")

    def dedup(self, docs: DataFrame) -> DataFrame:
        """``docs`` with text cut, n_lines and n_dropped (long).

        Lines are parted at newlines; a null or empty text is one empty line, and its text is then
        empty. The lost lines of a document travel to it, not the other way round; the text itself
        is read again and joined by document.

        Documents are counted by distinct doc_id. Rows of one doc_id are one document; a null
        doc_id is one document too, smaller than any other. Ties can't arise, as the largest
        doc_id keeps the line. An empty table gives no rows. Extra columns stay; those named like a
        result are refused.
        """
        if clash := [c for c in docs.columns if c.lower() in {"n_lines", "n_dropped"} or c.lower().startswith("_line_")]:
            raise ValueError(f"columns clash with the result: {clash}")
        lost = self.repeated(self.postings).groupBy(F.col("doc_id").alias("_line_doc")).agg(
            F.collect_list(F.struct("h1", "h2")).alias("_line_lost"))
        joined = docs.join(lost, F.col("doc_id").eqNullSafe(F.col("_line_doc")), "left")
        cut = _cutter(self.min_length)
        joined = joined.withColumn("_line_cut", cut(F.col("text"), F.col("_line_lost")))
        own = {c: joined[c] for c in docs.columns} | {"text": F.col("_line_cut.text").alias("text")}
        return joined.select(*own.values(), F.col("_line_cut.n_lines").alias("n_lines"),
                             F.col("_line_cut.n_dropped").alias("n_dropped"))


def _counted(postings: DataFrame, min_docs: int) -> DataFrame:
    return postings.groupBy("h1", "h2").agg(
        F.count("*").alias("n_docs"), F.max("doc_id").alias("top_doc")).where(F.col("n_docs") >= min_docs)


def _without(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Postings that are not among ``others``; null is a doc_id like any other."""
    theirs = others.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("doc_id").alias("_doc"))
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    return rows.join(theirs, same, "left_anti")


def _applied(base: DataFrame, net: DataFrame | None) -> DataFrame:
    if net is None:
        return base
    return _without(base, net.where("step < 0")).unionByName(net.where("step > 0").drop("step"))


def _new_filters(refs: DataFrame, shards: int) -> DataFrame:
    return refs.select("h1", _shard(shards)).groupBy("shard").applyInArrow(_new_filter, "shard int, filter binary")


def _new_filter(table: pa.Table) -> pa.Table:
    keys = np.unique(table.column("h1").to_numpy())
    shard = table.column("shard")[0].as_py()
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([CuckooFilter.of(keys).dump()], pa.binary())})


def _changed_filters(old: LineIndex, refs: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The old filters with keys that now reach the count inserted, and those that fell below it removed.

    ``before`` and ``after`` are the old and new refs of the keys that were touched.
    """
    n = old.shards
    h1 = lambda df: df.select("h1").distinct()
    change = h1(after).join(h1(before), "h1", "left_anti").select("h1", F.lit(1).alias("step")).unionByName(
        h1(before).join(h1(after), "h1", "left_anti").select("h1", F.lit(-1).alias("step"))
    ).select("h1", "step", _shard(n))

    def change_one(key, filters: pa.Table, changes: pa.Table) -> pa.Table:
        if filters.num_rows:
            made = CuckooFilter.load(filters.column("filter")[0].as_py())
        else:
            made = CuckooFilter.of(np.zeros(0, dtype=_U))
        keys, steps = changes.column("h1").to_numpy(), changes.column("step").to_numpy()
        full = False
        for k in keys[steps < 0]:
            made.remove(np.int64(k).astype(_U))
        for k in keys[steps > 0]:
            full = full or not made.insert(np.int64(k).astype(_U))
        raw = b"" if full else made.dump()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([raw], pa.binary())})

    changed = stash(old.filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInArrow(
        change_one, "shard int, filter binary"), "line-filters-changed")
    # A filter that ran full is built anew from the exact table.
    full = changed.where(F.length("filter") == 0).select("shard")
    anew = refs.select("h1", "h2", _shard(n)).join(full, "shard", "left_semi")
    return changed.where(F.length("filter") > 0).unionByName(_new_filters(anew, n))


def _probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines that their shard's filter holds; the filter of a shard comes before its lines."""
    at, held = None, None
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        kind = batch.column("kind").to_numpy()
        keys = batch.column("h1").fill_null(0).to_numpy()
        keep = np.zeros(len(shard), dtype=bool)
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1, [len(shard)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if kind[a] == 0:
                at, held = shard[a], CuckooFilter.load(batch.column("filter")[int(a)].as_py())
            elif at == shard[a]:
                keep[a:b] = held.holds(keys[a:b].astype(_U))
        chosen = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(chosen) for c in ("h1", "h2", "doc_id")], ["h1", "h2", "doc_id"])


def _cutter(min_length: int):
    @F.arrow_udf("text string, n_lines long, n_dropped long")
    def cut(text: pa.Array, lost: pa.Array) -> pa.Array:
        texts, n_lines, n_dropped = [], [], []
        for raw, gone in zip(_texts(text), lost, strict=True):
            lines = raw.split(b"\n")
            n_lines.append(len(lines))
            if gone.is_valid:
                keys = {(x["h1"], x["h2"]) for x in gone.as_py()}
                kept = [x for x in lines if line_key(x, min_length) not in keys]
                texts.append(b"\n".join(kept))
                n_dropped.append(len(lines) - len(kept))
            else:
                texts.append(raw)
                n_dropped.append(0)
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            ["text", "n_lines", "n_dropped"])

    return cut


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with repeated lines dropped: doc_id, n_lines, n_dropped, kept_sha256."""
    docs = require(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id", "text"])
    cut = LineIndex.build(docs).dedup(docs)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP5_SQL = f"""
WITH parted AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT doc_id, place, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM parted),
refs AS (
  SELECT key, max(doc_id) AS top_doc FROM keyed WHERE length(key) >= {MIN_LENGTH}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (
  SELECT k.doc_id, k.place, k.line, r.key IS NOT NULL AND k.doc_id <> r.top_doc AS gone
  FROM keyed k LEFT JOIN refs r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
