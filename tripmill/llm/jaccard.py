"""Exact Jaccard self-join of word shingles by index lists, with set relations to skip work."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import connected, folded_words, lean, mix64, require, shuffles, stash, texts_in_pieces

WORDS = 5
#: Similarity as a share in percent, so that the test is on whole numbers.
PERCENT = 75
#: Cells of the counts that order shingles, and of the marks that say whose sets are wanted.
CELLS = 1 << 20
SLICE = 1 << 14
#: Index entries that one partition holds, about.
ENTRIES = 1 << 20
#: A list of a shingle counted in more documents than the average cell by this factor is dealt to several tasks.
HEAVY, PARTS = 16, 32
#: Position blocks per list block.
BLOCKS = 16
#: Bits of a set's sketch for each of its shingles, before rounding up to a power of two.
SKETCH = 4

_U = np.uint64
_ENTRY = np.dtype([("token", "<u8"), ("sid", "<i8"), ("n", "<i4"), ("pos", "<i4")])


# ---- sets ------------------------------------------------------------------------------------

def document_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each whole text. Fewer words are one shingle; none, an empty set."""
    step = _U(0x9FB21C651E98DF25)
    for start, _, raw, offsets in texts_in_pieces(column):
        hashes, _, first = folded_words(raw, offsets)
        n = len(hashes) - words + 1
        shingles = np.full(max(n, 0), _U(words))
        for j in range(words):
            if n > 0:
                shingles = (shingles + hashes[j:j + n]) * step
        shingles = mix64(shingles)
        for row in range(len(first) - 1):
            a, b = int(first[row]), int(first[row + 1])
            if b - a >= words:
                yield start + row, np.unique(shingles[a:b - words + 1])
            elif b > a:
                whole = np.asarray([b - a], dtype=_U)
                for h in hashes[a:b]:
                    whole = (whole + h) * step
                yield start + row, mix64(whole)
            else:
                yield start + row, np.zeros(0, dtype=_U)


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set, whatever its order."""
    both = np.asarray([(mix64(shingles)).sum(dtype=_U), mix64(shingles * _U(0xA24BAED4963EE407) + _U(1)).sum(dtype=_U)])
    mixed = mix64(both + _U(len(shingles))).view(np.int64)
    return int(mixed[0]), int(mixed[1])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bits of a set, 64 to a word: bit i says whether an odd number of shingles have i in their top bits."""
    bits = max(6, math.ceil(math.log2(SKETCH * max(len(shingles), 1))))
    odd = np.bincount((shingles >> _U(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint8) & 1
    return np.packbits(odd).view(_U)


def folded_sketch(bits: np.ndarray, size: int) -> np.ndarray:
    """The same set's sketch in ``size`` words: neighbours of equal top bits fall together, and parities add up."""
    data = np.unpackbits(bits.view(np.uint8))
    return np.packbits(np.bitwise_xor.reduce(data.reshape(size * 64, -1), axis=1)).view(_U)


def most_shared(x: np.ndarray, y: np.ndarray, nx: int, ny: int) -> int:
    """An upper bound of two sets' overlap: every bit that differs stands for a shingle that only one of them has."""
    size = min(len(x), len(y))
    x, y = (v if len(v) == size else folded_sketch(v, size) for v in (x, y))
    apart = int(np.bitwise_count(x ^ y).sum())
    return min(nx, ny, (nx + ny - apart) // 2)


def _slices(cells: np.ndarray) -> pa.RecordBatch:
    held = [(i, zlib.compress(x.tobytes(), 1)) for i, x in enumerate(cells.reshape(-1, SLICE)) if x.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in held], pa.int32()), pa.array([b for _, b in held], pa.binary())], ["slice", "cells"])


def add_up(slices: DataFrame) -> np.ndarray:
    """Sums of partial counts: CELLS numbers, whatever the input. Added in the tasks; the driver gets the sums."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column("slice").to_pylist(), batch.column("cells"), strict=True):
                part = np.frombuffer(zlib.decompress(raw.as_py()), dtype=np.uint32)
                sums[i] = part.astype(_U) + sums.get(i, _U(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())],
            ["slice", "cells"])

    total = np.zeros(CELLS, dtype=_U)
    for row in slices.repartition("slice").mapInArrow(add, "slice int, cells binary").collect():
        total[row["slice"] * SLICE:(row["slice"] + 1) * SLICE] += np.frombuffer(zlib.decompress(row["cells"]), dtype=_U)
    return total


def _survey(words: int) -> Callable:
    """Per document its set's size and hashes, with a sketch where the task meets the set first; and per task
    how often shingles fall in each cell.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.uint32)
        names = ["doc_id", "n", "s1", "s2", "sketch", "slice", "cells"]
        drawn: set[int] = set()
        for batch in batches:
            n, s1, s2, sketches, waiting, held = [], [], [], [], [], 0
            for _, shingles in document_sets(batch.column("text"), words):
                a, b = signature(shingles)
                n.append(len(shingles))
                s1.append(a)
                s2.append(b)
                sketches.append(sketch(shingles).tobytes() if len(shingles) and a not in drawn else None)
                drawn.add(a)
                waiting.append(shingles)
                held += len(shingles)
                if held > CELLS // 4:
                    cells += np.bincount((np.concatenate(waiting) & _U(CELLS - 1)).astype(np.int64), minlength=CELLS).astype(np.uint32)
                    waiting, held = [], 0
            if waiting:
                cells += np.bincount((np.concatenate(waiting) & _U(CELLS - 1)).astype(np.int64), minlength=CELLS).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(sketches, pa.binary()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names)
        own = _slices(cells)
        k = len(own)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(k, pa.int64()) for _ in range(4)), pa.nulls(k, pa.binary()), *own.columns], names)

    return run


# ---- index lists -----------------------------------------------------------------------------

def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _index(words: int, percent: int, kinds: np.ndarray, heavy: int, partitions: int) -> Callable:
    """Entries of each set's prefix in the order of (kind of frequency, hash), dealt by shingle.

    A task sends an equal set once. Entries travel as bytes, one value per partition and batch.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            found = []
            for _, shingles in document_sets(batch.column("text"), words):
                n = len(shingles)
                if not n or (sid := signature(shingles)[0]) in sent:
                    continue
                sent.add(sid)
                ranked = (kinds[(shingles & _U(CELLS - 1)).astype(np.int64)].astype(_U) << _U(58)) | (shingles >> _U(6))
                ranked.sort()
                own = np.empty(_prefix(n, percent), dtype=_ENTRY)
                own["token"] = ranked[:len(own)]
                own["sid"], own["n"], own["pos"] = sid, n, np.arange(len(own))
                found.append(own)
            if not found:
                continue
            entries = np.concatenate(found)
            mixed = mix64(entries["token"])
            part = (mixed % _U(partitions)).astype(np.int64)
            hot = (entries["token"] >> _U(58)) >= heavy
            # A frequent shingle's list goes to PARTS partitions, by set.
            part[hot] = (mixed[hot] + mix64(entries["sid"][hot].astype(_U)) % _U(PARTS)) % _U(partitions)
            order = np.argsort(part, kind="stable")
            entries, part = entries[order], part[order]
            at = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[at[:-1]], pa.int64()),
                 pa.array([entries[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                ["part", "entries"])

    return run


def _lists(heavy: int) -> Callable:
    """Entries (token, sid, n, pos) of lists with two sets at least, or of frequent shingles.

    A list is named by a hash of its sets, so that lists of equal sets may become one; the part of a
    frequent shingle's list keeps the shingle.
    """
    names = ["token", "sid", "n", "pos"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x.as_py() for b in batches for x in b.column("entries")]
        if not blobs:
            return
        e = np.frombuffer(b"".join(blobs), dtype=_ENTRY)
        del blobs
        e = e[np.argsort(e["token"], kind="stable")]
        first = np.concatenate([[True], e["token"][1:] != e["token"][:-1]])
        many = ~first | np.concatenate([~first[1:], [False]]) | ((e["token"] >> _U(58)) >= heavy)
        e = e[many]
        e = e[np.lexsort((e["pos"], e["sid"], e["n"], e["token"]))]
        again = np.zeros(len(e), dtype=bool)
        again[1:] = (e["token"][1:] == e["token"][:-1]) & (e["sid"][1:] == e["sid"][:-1])
        e = e[~again]
        if not len(e):
            return
        start = np.flatnonzero(np.concatenate([[True], e["token"][1:] != e["token"][:-1]]))
        size = np.diff(np.concatenate([start, [len(e)]]))
        hot = (e["token"] >> _U(58)) >= heavy
        keep = np.flatnonzero((np.repeat(size, size) > 1) | hot)
        name = mix64(np.add.reduceat(mix64(e["sid"].view(_U) if e["sid"].flags.c_contiguous else e["sid"].astype(_U)), start))
        name = np.where(hot, e["token"], np.repeat(name, size))
        for at in range(0, len(keep), 100_000):
            k = keep[at:at + 100_000]
            x = e[k]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (name[k].view(np.int64), x["sid"], x["n"], x["pos"])], names)

    return run


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """The least overlap of two linked sets: 100 i >= p (na + nb - i)."""
    return F.ceil(F.lit(percent) * (na + nb) / F.lit(100 + percent))


def _may_link(percent: int, n: str, pos: str, other_n: str, other_pos: str) -> Column:
    """Whether sets that first meet at these positions can reach the similarity."""
    a, b = F.col(n), F.col(other_n)
    rest = F.least(a - F.col(pos), b - F.col(other_pos))
    return (F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)) & (rest >= _needed(a, b, percent))


def _prefix_size(n: Column, percent: int) -> Column:
    return n - F.ceil(F.lit(percent) * n / F.lit(100)) + 1


# ---- overlaps --------------------------------------------------------------------------------

def limits(sketches: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b, na, nb) with ``most``, an upper bound of the overlap, from the sketches (sid, sketch) of all sets."""

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = [
                most_shared(np.frombuffer(x.as_buffer(), dtype=_U), np.frombuffer(y.as_buffer(), dtype=_U), nx, ny)
                for x, y, nx, ny in zip(batch.column("x"), batch.column("y"), batch.column("na").to_pylist(),
                                        batch.column("nb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(most, pa.int64())], ["a", "b", "na", "nb", "most"])

    named = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    held = stash(sketches.join(named, "sid", "left_semi").dropDuplicates(["sid"]), "sketches")
    both = pairs.select("a", "b", "na", "nb").join(held.select(F.col("sid").alias("a"), F.col("sketch").alias("x")), "a").join(
        held.select(F.col("sid").alias("b"), F.col("sketch").alias("y")), "b")
    return both.mapInArrow(bound, "a long, b long, na int, nb int, most long")


def overlaps(docs: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(a, b, shared) of pairs of set hashes, counted on the whole sets.

    Only sets that some pair names leave the tasks that read the texts; which ones is told by
    CELLS marks, a superset at any size.
    """
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid")))

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.uint32)
        for batch in batches:
            cells[batch.column("sid").to_numpy() & (CELLS - 1)] = 1
        yield _slices(cells)

    marks = add_up(wanted.mapInArrow(lean(mark), "slice int, cells binary")) > 0

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            ids, blobs, held = [], [], 0
            for _, shingles in document_sets(batch.column("text"), words):
                sid = signature(shingles)[0]
                if not marks[sid & (CELLS - 1)] or sid in sent:
                    continue
                sent.add(sid)
                ids.append(sid)
                blobs.append(shingles.tobytes())
                held += shingles.nbytes
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["sid", "shingles"])
                    ids, blobs, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["sid", "shingles"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=_U), np.frombuffer(y.as_buffer(), dtype=_U)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                shared.append(int((y[at] == x).sum()) if len(y) else 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int64())], ["a", "b", "shared"])

    named = wanted.distinct()
    held = require(docs, ["text"]).mapInArrow(lean(sets), "sid long, shingles binary").join(named, "sid", "left_semi")
    held = stash(held.dropDuplicates(["sid"]), "sets")
    both = pairs.join(held.select(F.col("sid").alias("a"), F.col("shingles").alias("x")), "a").join(
        held.select(F.col("sid").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(lean(count), "a long, b long, shared long")


# ---- the join --------------------------------------------------------------------------------

def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies): one row per row of ``docs`` (doc_id, text).

    Two documents link when 100 * shared >= percent * (sum of sizes - shared) for their sets of
    shingles; a component is named by its smallest doc_id. No link between different sets is lost:

    1. Equal sets are one set from the start (n_copies: its rows).
    2. Index lists hold each set under the shingles of its prefix, rare ones first by counts of all
       documents in a fixed number of cells. Any order gives whole results; counts keep lists short.
    3. Every set is compared with the leader of each of its lists, the most central set there, so a
       list costs its length, not its square. What links is one class.
       A pair's overlap is counted on the whole sets unless their sketches, kept from step 1, prove it too small.
    4. Only sets of different classes are compared further. Lists are cut into blocks by size and
       position, and blocks that can't hold a partner are skipped. For a pair met in a list, the
       overlaps of both with the leader, already computed or bounded, bound their own overlap from both sides:
       most pairs are refused or linked by that alone, others are refused by sketches, the rest are counted.

    Sets are told apart by 64 bits of hash (and copies by 128), so n sets are mixed up with a chance of about
    n * n / 2**65.

    A null or empty text has no shingles and links with nothing. A null doc_id takes no part in
    links, and its component is null. Rows of one doc_id with different texts are one node. An
    empty table gives no rows. Extra columns are left out.
    """
    docs = require(docs, ["doc_id", "text"])
    spark = docs.sparkSession
    survey = stash(docs.mapInArrow(
        lean(_survey(words)), "doc_id long, n long, s1 long, s2 long, sketch binary, slice int, cells binary"), "sets-survey")
    cells = add_up(survey.where(F.col("slice").isNotNull()).select("slice", "cells"))
    known = survey.where(F.col("slice").isNull()).select("doc_id", "n", "s1", "s2")
    sketches = survey.where(F.col("sketch").isNotNull()).select(F.col("s1").alias("sid"), "sketch")
    nodes = known.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("s1", "s2", "n").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("n_copies"))
    entries = known.agg(F.sum(_prefix_size(F.col("n"), percent))).first()[0] or 0
    partitions = max(shuffles(spark), math.ceil(entries / ENTRIES))
    kinds = np.floor(np.log2(cells.astype(np.float64) + 1)).astype(np.uint8)
    heavy = int(math.log2(max(64.0, HEAVY * float(cells.mean()))))

    index = docs.mapInArrow(lean(_index(words, percent, kinds, heavy, 8 * partitions)), "part long, entries binary")
    dealt = index.repartition(partitions, "part").mapInArrow(lean(_lists(heavy)), "token long, sid long, n int, pos int")
    # Lists of equal sets are one, with each set's first position.
    lists = stash(dealt.groupBy("token", "sid").agg(
        F.min("n").alias("n"), F.min("pos").alias("pos"), F.count("*").alias("shingles")), "lists")
    # The leader of a list is its most central set: the one with the largest share of its prefix
    # in lists with others, as an original has among its altered copies; then the smallest.
    central = lists.groupBy("sid").agg((-F.sum("shingles") / F.max(_prefix_size(F.col("n"), percent))).alias("rank"))
    ranked = lists.join(central, "sid")
    tops = ranked.groupBy("token").agg(F.min(F.struct("rank", "n", "sid", "pos")).alias("top"))
    lists = stash(lists.join(tops, "token").select(
        "token", "sid", "n", "pos", F.col("top.sid").alias("leader"), F.col("top.n").alias("leader_n"),
        F.col("top.pos").alias("leader_pos")), "led-lists")

    stars = lists.where((F.col("sid") != F.col("leader")) & _may_link(percent, "n", "pos", "leader_n", "leader_pos"))
    stars = stars.groupBy(F.col("leader").alias("a"), F.col("sid").alias("b")).agg(
        F.first("leader_n").alias("na"), F.first("n").alias("nb"))
    stars = stash(stars, "stars")
    need = _needed(F.col("na"), F.col("nb"), percent)
    stars = stash(limits(sketches, stars), "limits")
    likely = stars.where(F.col("most") >= need)
    counted = overlaps(docs, likely.select("a", "b"), words)
    known_overlaps = stash(stars.join(counted, ["a", "b"], "left"), "overlaps")
    linked = F.col("shared") >= need
    links = known_overlaps.where(linked).select("a", "b")
    classes = connected(links).checkpoint()

    # Lists whose sets beside the leader, which has met them all, are of more than one class.
    member = classes.select(F.col("node").alias("sid"), "component")
    classed = lists.where(F.col("sid") != F.col("leader")).join(member, "sid", "left").withColumn("class", F.coalesce("component", "sid")).drop("component")
    mixed = classed.groupBy("token").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y").select("token")
    open_lists = classed.join(mixed, "token", "left_semi")
    # What each set shares with the leader of its list, at least and at most.
    told = known_overlaps.select(
        F.col("a").alias("leader"), F.col("b").alias("sid"), F.coalesce("shared", F.lit(0).cast("long")).alias("least"),
        F.coalesce("shared", "most").alias("most"))
    open_lists = stash(open_lists.join(told, ["leader", "sid"], "left"), "open-lists")
    pairs = _across(open_lists, percent)
    pairs = stash(pairs, "pairs")
    sure = pairs.where("sure").select("a", "b")
    likely = stash(limits(sketches, pairs.where("not sure")).where(F.col("most") >= need), "likely")
    more = overlaps(docs, likely.select("a", "b"), words).join(likely, ["a", "b"]).where(linked).select("a", "b").unionByName(sure)
    classes = connected(links.unionByName(more))

    # From sets to documents: a component's name is its smallest document.
    member = classes.select(F.col("node").alias("s1"), "component")
    placed = nodes.join(member, "s1", "left").withColumn("component", F.coalesce("component", "s1"))
    names = placed.groupBy("component").agg(F.min("node").alias("component_id"))
    placed = placed.join(names, "component").select("s1", "s2", "n", "component_id", "n_copies")
    out = known.join(placed, ["s1", "s2", "n"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"))


def _band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(4 / 3) + 1e-9).cast("int")


def _across(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb, sure) of sets that share a list, are of different classes and may still link.

    A list's blocks are (band of sizes, share of the set that lies before the position). A set
    visits the blocks of its own and the next larger band that can hold a partner.
    """
    ratio = 4 / 3
    block = F.floor(F.col("pos") * BLOCKS / F.col("n")).cast("int")
    blocked = lists.select(
        "token", "sid", "n", "pos", "class", "leader_n", "least", "most", _band(F.col("n")).alias("band"), block.alias("block"))
    width = BLOCKS * (100 - percent) // 100 + 1
    steps = 1 + math.ceil(math.log(100 / percent) / math.log(ratio) - 1e-9)
    visits = blocked.withColumn("band", F.explode(F.sequence(F.col("band"), F.col("band") + steps))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(width))))
    low, high = F.pow(F.lit(ratio), F.col("band")) - 1, F.pow(F.lit(ratio), F.col("band") + 1) + 1
    reach = F.lit(percent / (100 + percent)) * (F.col("n") + F.greatest(low, F.col("n").cast("double")))
    visits = visits.where(
        (F.col("n") - F.col("pos") >= reach - 1) & (high * (1 - F.col("block") / BLOCKS) >= reach - 1))
    left = visits.select("token", "band", "block", *[F.col(c).alias(f"x_{c}") for c in ("sid", "n", "pos", "class", "least", "most")])
    right = blocked.select("token", "band", "block", *[F.col(c).alias(f"y_{c}") for c in ("sid", "n", "pos", "class", "least", "most", "leader_n")])
    once = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_sid") < F.col("y_sid")))
    met = left.join(right, ["token", "band", "block"]).where(
        once & (F.col("x_class") != F.col("y_class")) & _may_link(percent, "x_n", "x_pos", "y_n", "y_pos"))
    # Overlaps with the leader bound the overlap of the two.
    most = F.least(F.col("x_most") + F.col("y_n") - F.col("y_least"), F.col("y_most") + F.col("x_n") - F.col("x_least"))
    need = _needed(F.col("x_n"), F.col("y_n"), percent)
    least = F.col("x_least") + F.col("y_least") - F.col("y_leader_n")
    met = met.where(F.coalesce(most >= need, F.lit(True))).withColumn("sure", F.coalesce(least >= need, F.lit(False)))
    return met.groupBy(F.col("x_sid").alias("a"), F.col("y_sid").alias("b")).agg(
        F.first("x_n").alias("na"), F.first("y_n").alias("nb"), F.max("sure").alias("sure"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_shingles, component_id, n_copies."""
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
