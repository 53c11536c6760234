"""Best-fit packing of token sequences: exact complements by hashed length sums, then best fit."""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import lean, require, shuffles, stash

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Words whose ids a worker remembers.
REMEMBERED = 500_000
#: Words that the model is given in one call, at most.
CALL = 100
#: Pieces of one length that one task ranks, about.
RANKED = 50_000


# ---- the plan, on counts per length ----------------------------------------------------------

class _Sums:
    """Which lengths, and which pairs of lengths, are left to sum to a number."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def single(self, total: int) -> tuple[int, ...] | None:
        return (total,) if 0 < total < len(self.counts) and self.counts[total] else None

    def pair(self, total: int) -> tuple[int, int] | None:
        """The pair with the longest part."""
        if total < 2:
            return None
        half = total // 2
        low = np.arange(max(1, total - len(self.counts) + 1), half + 1)
        high = total - low
        ok = (self.counts[low] > 0) & (self.counts[high] > 0)
        if total % 2 == 0 and len(ok) and self.counts[half] < 2:
            ok[-1] = False
        found = np.flatnonzero(ok)
        return (int(high[found[0]]), int(low[found[0]])) if len(found) else None

    def triple(self, total: int) -> tuple[int, int, int] | None:
        """The triple with the longest part, by a lookup of the pair that complements it."""
        there = np.flatnonzero(self.counts[:max(0, total - 1)])
        for longest in there[::-1]:
            longest = int(longest)
            if 3 * longest < total:
                return None
            self.counts[longest] -= 1
            rest = self.pair(total - longest)
            self.counts[longest] += 1
            if rest:
                return (longest, *rest)
        return None


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """The shortest of the plans that complement lengths above 0, a third or half of the capacity by up to 1, 2 or 3 parts."""
    plans = (_plan(counts, capacity, capacity // share + 1, parts) for share in (2, 3, capacity + 1) for parts in (3, 2, 1))
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def _plan(counts: dict[int, int], capacity: int, least: int, parts: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, how many such sequences) that use up ``counts`` (length to number).

    What fills the gap of a length exactly is looked up from the longest down to ``least``, first among
    single lengths, then pairs, then triples (as many ``parts`` at most), and consumed as often as all parts are there. Each
    step uses up some length, so steps are bounded by ``capacity``. What has no exact complement is placed by best fit, longest
    first. Both work on counts, so neither grows with the number of pieces.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} doesn't fit {capacity}")
        left[length] = n
    sums, plan = _Sums(left), []
    if left[capacity]:
        plan.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    for find in (sums.single, sums.pair, sums.triple)[:parts]:
        for length in range(capacity - 1, least - 1, -1):
            while left[length]:
                left[length] -= 1
                rest = find(capacity - length)
                left[length] += 1
                if not rest:
                    break
                need = defaultdict(int)
                for part in (length, *rest):
                    need[part] += 1
                times = min(int(left[p]) // k for p, k in need.items())
                for p, k in need.items():
                    left[p] -= times * k
                plan.append(((length, *rest), times))
    residual = {int(p): int(left[p]) for p in np.flatnonzero(left)}
    return plan + _best_fit(residual, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first: each length goes to the fullest sequences that still take it."""
    open_at: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)

    def put(parts: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(parts)
        if n:
            open_at[gap][parts] = open_at[gap].get(parts, 0) + n

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            gap = min((g for g, held in open_at.items() if g >= length and held), default=None)
            if gap is None:
                each = capacity // length
                put((length,) * each, n // each)
                put((length,) * (n % each), 1 if n % each else 0)
                n = 0
                continue
            parts, have = next(iter(open_at[gap].items()))
            each = min(gap // length, n)
            times = min(have, n // each)
            left = have - times
            if left:
                open_at[gap][parts] = left
            else:
                del open_at[gap][parts]
            put(parts + (length,) * each, times)
            n -= each * times
    return [(parts, n) for held in open_at.values() for parts, n in held.items()]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Runs of places by length and rank: the rank-th piece of a length lies in the last run that begins at or before it."""
    rows, used, sequence = [], defaultdict(int), 0
    for parts, times in plan:
        offset, at = 0, 0
        while at < len(parts):
            rows.append((parts[at], used[parts[at]], sequence, offset))
            used[parts[at]] += times
            offset += parts[at]
            at += 1
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T, strict=True))


# ---- tokens ----------------------------------------------------------------------------------

# Bytes as the characters that a byte-level vocabulary writes for them: printable Latin ones are themselves, the others
# follow in order from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {}
for _b in range(256):
    _BYTE_CHARS[_b] = chr(_b) if _b in _PRINTED else chr(256 + _b - sum(x < _b for x in _PRINTED))
#: Words of letters alone that the model must give the ids of the whole tokenizer for, else it is not asked.
_PROBES = ("a", "word", "größe", "çedilla", "straße", "ñandú", "слово", "naïvetés", "zzzzzz")


# Where a mark ends a word after a Latin letter or a digit: a token run of its own, so words are looked up without it.
_END_MARK = re.compile(rb"[.,;:!?](?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))(?=\s|\Z)")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Ids of words as little-endian 32-bit bytes. No token of this vocabulary spans white space.

    Words are looked up with A-Z in lower case, which the tokenizer makes of them anyway; a word that
    holds one of the vocabulary's special marks is looked up as it is written, as these are found before letters are folded.
    Words of letters alone go to the model, all of a text in one call. Holds the words of the latest texts; those not met
    again for long are forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The model alone, which takes words that need no folding or cutting.
        self.letters = Tokenizer(self.tokenizer.model)
        self.held: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        probes = [w.encode() for w in _PROBES]
        self.plain = self._letters([self._one_piece(w) for w in probes]) == [self._encode(w) for w in probes]

    def _encode(self, word: bytes) -> bytes:
        return _packed(self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids)

    def _letters(self, words: list[str]) -> list[bytes]:
        """Of folded, composed words of letters alone, each of which is one piece for the model."""
        told = self.letters.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.asarray(told.ids, dtype="<u4").tobytes()
        size = np.bincount(np.asarray(told.word_ids, dtype=np.int64), minlength=len(words))
        end = (4 * np.cumsum(size)).tolist()
        return [ids[a:b] for a, b in zip([0, *end], end, strict=False)]

    def _one_piece(self, word: bytes) -> str | None:
        """A word of letters alone as the model reads it, else None."""
        if word.isascii():
            return word.decode("ascii") if word.isalpha() else None
        text = word.decode("utf-8")
        if not text.isalpha():
            return None
        if max(text) <= "\u00ff":
            text = text.lower()
        elif text != text.lower() or not unicodedata.is_normalized("NFC", text):
            return None
        return "".join(map(_BYTE_CHARS.__getitem__, text.encode()))

    def _learn(self, words: Iterable[bytes]) -> None:
        """Hold words that are not held."""
        held, older, names, spelt = self.held, self.older.get, [], []
        for word in words:
            ids = older(word)
            if ids is None:
                piece = self._one_piece(word) if self.plain else None
                if piece is not None:
                    names.append(word)
                    spelt.append(piece)
                    continue
                ids = self._encode(word)
            held[word] = ids
        for at in range(0, len(names), CALL):
            held.update(zip(names[at:at + CALL], self._letters(spelt[at:at + CALL]), strict=True))

    def _of(self, words: list[bytes]) -> list[bytes]:
        new = set(words).difference(self.held)
        if new:
            self._learn(new)
        out = [*map(self.held.__getitem__, words)]
        if len(self.held) >= REMEMBERED // 2:
            self.older, self.held = self.held, {}
        return out

    def ids(self, text: bytes) -> bytes:
        """Ids of a whole text."""
        if not any(mark in text for mark in self.marks):
            # Folding letters could make a special mark of what is none.
            folded = text.lower()
            if not any(mark in folded for mark in self.marks):
                return b"".join(self._of(_END_MARK.sub(rb" \g<0>", folded).split()))
        return b"".join([self._as_written(w) for w in text.split()])

    def _as_written(self, word: bytes) -> bytes:
        folded = word.lower()
        return self._encode(word) if any(mark in folded for mark in self.marks) else self._of([folded])[0]


#: One memory per vocabulary and worker, kept from task to task.
_WORDS: dict[str, WordIds] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of whole texts, longer ones cut every ``capacity`` ids."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WORDS.get(tokenizer) or _WORDS.setdefault(tokenizer, WordIds(tokenizer))
        step = 4 * capacity
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                raw = words.ids(text.as_py() or b"") + end
                for k, at in enumerate(range(0, len(raw), step)):
                    own = raw[at:at + step]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
            ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return require(docs, ["doc_id", "text"]).mapInArrow(lean(cut), schema)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document in a sequence of at most ``capacity`` tokens.

    Returns (doc_id, piece, start, length, ids_crc32, sequence_id, offset). ``tokenizer`` is the
    file of a vocabulary whose tokens do not span white space.

    The plan is made from the number of pieces per length, at most ``capacity`` numbers however
    many pieces there are. Pieces then learn their rank among those of their length, from counts
    per length and bucket and a rank inside the bucket, and find their place from their rank.

    A null or empty text is one piece of the end id alone. Rows with equal or null doc_id are
    packed as often as they occur. Ties between pieces of one length are broken by doc_id and
    piece. An empty table gives no rows. Extra columns are left out.
    """
    import public_tokenizers

    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    cut = stash(pieces(docs, path, capacity, end_id), "pieces")
    by_length = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = max(shuffles(spark), -(-max(by_length.values(), default=0) // RANKED))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("own", F.row_number().over(inside) - 1).join(bases, ["length", "bucket"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("own")).alias("rank"))
    table = slots(pack_counts(by_length, capacity))
    # One number orders runs by length, then rank; both are far below its halves.
    runs = (table["length"] << 48) | table["rank"]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(runs, (batch.column("length").to_numpy() << 48) | rank, side="right") - 1
            own = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(table["sequence"][at] + rank - table["rank"][at]), pa.array(table["offset"][at])],
                [*own.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(
        lean(place), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed, one row per piece."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
