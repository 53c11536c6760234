"""Language-model scores by context-tree weighting over bytes, beside a unigram base."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import folded_words, mix64, require, shuffles, stash

#: Bytes of context. A gram is a context, newest byte first, and the byte that follows it.
DEPTH = 5
#: Bytes of text in a block of documents, and numbers that one shard of the counts gets, about.
BLOCK_BYTES, SHARD_ENTRIES = 1 << 24, 1 << 22
HOLD_OUT, HELD = 7, 2
_PIECE = 1 << 22

_U = np.uint64
_MESSAGE = "block int, kind string, shard int, keys binary, numbers binary"


# ---- texts -----------------------------------------------------------------------------------

def canonical(text: bytes) -> bytes:
    """Words in lower case (A-Z), one space between them, one newline as the end."""
    return b" ".join(text.lower().split()) + b"\n"


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held > _PIECE:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram per scored byte, first gram of each text and the end) of canonical texts.

    Before its first byte a text has newlines for a context.
    """
    pad = b"\n" * (DEPTH - 1)
    data = np.frombuffer(b"\n" + pad + pad.join(texts), dtype=np.uint8)
    size = np.asarray([len(t) for t in texts])
    n = len(data) - DEPTH
    key = np.zeros(n, dtype=_U)
    for d in range(1, DEPTH + 1):
        key = (key << _U(8)) | data[DEPTH - d:DEPTH - d + n]
    key = (key << _U(8)) | data[DEPTH:]
    begin = np.concatenate([[0], np.cumsum(size + DEPTH - 1)])[:-1]
    first = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(first[-1]) + np.repeat(begin - first[:-1], size)
    return key[place], first


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = b"".join(texts)
    hashes, _, first = folded_words(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    return hashes, first


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their numbers."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[start], np.add.reduceat(counts, start)


def _tally(values: np.ndarray, first: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and how often each occurs in training texts."""
    learned = np.repeat(train, np.diff(first))
    order = np.sort(values)
    keys = order[np.concatenate([[True], order[1:] != order[:-1]])] if len(order) else order
    counts = np.zeros(len(keys), dtype=np.int64)
    own = np.sort(values[learned]) if not learned.all() else order
    if len(own):
        at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        counts[np.searchsorted(keys, own[at])] = np.diff(np.concatenate([at, [len(own)]]))
    return keys, counts


def _texts_of(docs: pa.Table) -> list[bytes]:
    return [canonical(t.as_py() or b"") for chunk in docs.column("text").chunks for t in chunk.cast(pa.binary())]


def _asker(shards: int):
    """Every gram and word of a block with its training count, dealt by shard."""

    def ask(docs: pa.Table) -> pa.Table:
        texts, train = _texts_of(docs), docs.column("train").to_numpy().astype(bool)
        parts: dict[str, list] = {"gram": [], "word": []}
        for a, b in _runs(texts):
            for kind, of in (("gram", grams), ("word", _words)):
                parts[kind].append(_tally(*of(texts[a:b]), train[a:b]))
        rows = []
        for kind, held in parts.items():
            keys, counts = _summed(held)
            # Grams of one two-byte context share a shard, as its tree hangs together.
            shard = (mix64(keys >> _U(8 * (DEPTH - 1))) if kind == "gram" else keys) % _U(shards)
            order = np.argsort(shard, kind="stable")
            keys, counts, shard = keys[order], counts[order], shard[order]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            rows += [(kind, int(shard[x]), keys[x:y].tobytes(), counts[x:y].astype("<u4").tobytes())
                     for x, y in zip(cut[:-1], cut[1:], strict=True) if y > x]
        kind, shard, keys, counts = zip(*rows, strict=True)
        block = docs.column("block")[0].as_py()
        return pa.table({
            "block": pa.array([block] * len(rows), pa.int32()), "kind": pa.array(kind), "shard": pa.array(shard, pa.int32()),
            "keys": pa.array(keys, pa.binary()), "numbers": pa.array(counts, pa.binary())})

    return ask


# ---- the tree --------------------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros(x.shape)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones, in any order."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def weigh(log_pe: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, share of the node's own estimate) from its estimate and its children's product."""
    log_pw = np.logaddexp(log_pe, below) - np.log(2)
    return log_pw, np.exp(log_pe - np.log(2) - log_pw)


class Level:
    """Nodes of all depths from ``above`` + 1 to DEPTH for one of a byte's eight bits, over sorted distinct grams.

    A node is a context and the bits before this one. ``inverse[d]`` leads from grams to nodes.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bit: int, above: int):
        byte = keys & _U(255)
        self.prefix = (_U(1) << _U(bit)) | (byte >> _U(8 - bit))
        self.ones = ((byte >> _U(7 - bit)) & _U(1)).astype(np.int64)
        self.inverse, self.n, self.share, self.log_pw = {}, {}, {}, {}
        for d in range(DEPTH, above, -1):
            context = keys >> _U(8 * (DEPTH - d + 1))
            _, first, inverse = np.unique((context << _U(8)) | self.prefix, return_index=True, return_inverse=True)
            n1 = np.bincount(inverse, counts * self.ones)
            n0 = np.bincount(inverse, counts) - n1
            log_pe = log_kt(n0, n1)
            if d == DEPTH:
                self.log_pw[d], self.share[d] = log_pe, np.ones(len(log_pe))
            else:
                below = np.bincount(inverse[heads], self.log_pw[d + 1], minlength=len(log_pe))
                self.log_pw[d], self.share[d] = weigh(log_pe, below)
            self.inverse[d], self.n[d], heads = inverse, (n0, n1), first

    def predict(self) -> np.ndarray:
        """The mixed probability of each gram's own bit, from the deepest node up."""
        p = np.zeros(len(self.ones))
        for d in sorted(self.n, reverse=True):
            n0, n1 = (n[self.inverse[d]] for n in self.n[d])
            kt = (np.where(self.ones == 1, n1, n0) + 0.5) / (n0 + n1 + 1)
            share = self.share[d][self.inverse[d]]
            p = share * kt + (1 - share) * p
        return p


def top_sums(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(newest byte, bits, zeros, ones, log product of the two-byte contexts below) of one shard."""
    out = []
    for bit in range(8):
        level = Level(keys, counts, bit, 1)
        newest = keys >> _U(8 * DEPTH)
        nodes, inverse = np.unique((newest << _U(8)) | level.prefix, return_inverse=True)
        n1 = np.bincount(inverse, counts * level.ones)
        n0 = np.bincount(inverse, counts) - n1
        _, first = np.unique(level.inverse[2], return_index=True)
        below = np.bincount(inverse[first], level.log_pw[2], minlength=len(nodes))
        out.append(np.column_stack([nodes >> _U(8), nodes & _U(255), n0, n1, below]))
    return np.concatenate(out)


class Top:
    """The nodes of no and of one byte of context, from the sums of all shards: at most 65,536 of each number."""

    def __init__(self, rows: np.ndarray):
        self.n0, self.n1, below = (np.zeros(1 << 16) for _ in range(3))
        at = (rows[:, 0] * 256 + rows[:, 1]).astype(int)
        self.n0[at], self.n1[at], below[at] = rows[:, 2], rows[:, 3], rows[:, 4]
        log_pw, self.share = weigh(log_kt(self.n0, self.n1), below)
        sums = lambda x: x.reshape(256, 256).sum(axis=0)
        self.root0, self.root1 = sums(self.n0), sums(self.n1)
        _, self.root_share = weigh(log_kt(self.root0, self.root1), sums(log_pw))

    def mix(self, p: np.ndarray, newest: np.ndarray, prefix: np.ndarray, ones: np.ndarray) -> np.ndarray:
        at, bits = (newest * _U(256) + prefix).astype(np.int64), prefix.astype(np.int64)
        for n0, n1, share, where in ((self.n0, self.n1, self.share, at), (self.root0, self.root1, self.root_share, bits)):
            kt = (np.where(ones == 1, n1[where], n0[where]) + 0.5) / (n0[where] + n1[where] + 1)
            p = share[where] * kt + (1 - share[where]) * p
        return p


def log10_bytes(keys: np.ndarray, counts: np.ndarray, top: Top) -> np.ndarray:
    """log10 of the model's probability of each gram's last byte after its context."""
    total = np.zeros(len(keys))
    for bit in range(8):
        level = Level(keys, counts, bit, 1)
        total += np.log10(top.mix(level.predict(), keys >> _U(8 * DEPTH), level.prefix, level.ones))
    return total


# ---- shards ----------------------------------------------------------------------------------

def _messages(group: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    keys = [np.frombuffer(k.as_buffer(), dtype=_U) for k in group.column("keys")]
    counts = [np.frombuffer(n.as_buffer(), dtype="<u4").astype(np.int64) for n in group.column("numbers")]
    return keys, *_summed(list(zip(keys, counts, strict=True)))


def _answers(group: pa.Table, asked: list[np.ndarray], keys: np.ndarray, values: np.ndarray) -> pa.Table:
    numbers = [values[np.searchsorted(keys, k)].tobytes() for k in asked]
    return group.set_column(group.schema.get_field_index("numbers"), "numbers", pa.array(numbers, pa.binary()))


def _count_words(group: pa.Table) -> pa.Table:
    """Answers of a shard of words: their training counts. One more row, of block -1, has (distinct, all)."""
    asked, keys, counts = _messages(group)
    sums = np.asarray([(counts > 0).sum(), counts.sum()], dtype="<i8").tobytes()
    total = pa.table({
        "block": pa.array([-1], pa.int32()), "kind": pa.array(["word"]), "shard": group.column("shard").slice(0, 1),
        "keys": pa.array([b""], pa.binary()), "numbers": pa.array([sums], pa.binary())})
    return pa.concat_tables([_answers(group, asked, keys, counts.astype("<i8")), total.cast(group.schema)])


def _sum_tops(group: pa.Table) -> pa.Table:
    _, keys, counts = _messages(group)
    rows = top_sums(keys, counts)
    return pa.table(dict(zip(("c", "q", "n0", "n1", "below"), rows.T.copy(), strict=True)))


def _scorer(words: int, tokens: int, n_train: int):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _texts_of(docs)
        tables = {}
        for kind, number in (("gram", "<f8"), ("word", "<i8")):
            own = answers.filter(pc.equal(answers.column("kind"), kind))
            keys = np.concatenate([np.zeros(0, _U), *(np.frombuffer(k.as_buffer(), dtype=_U) for k in own.column("keys"))])
            numbers = np.concatenate([np.zeros(0, number), *(np.frombuffer(k.as_buffer(), dtype=number) for k in own.column("numbers"))])
            order = np.argsort(keys)
            tables[kind] = keys[order], numbers[order]
        rest = np.log10(tokens + words + 1.0)
        out = {"n_tokens": [], "n_known": [], "base_score": [], "score": [], "n_bytes": []}
        for a, b in _runs(texts):
            keys, first = grams(texts[a:b])
            each = tables["gram"][1][np.searchsorted(tables["gram"][0], keys)]
            out["score"].append(np.add.reduceat(each, first[:-1]))
            out["n_bytes"].append(np.diff(first))
            hashes, first = _words(texts[a:b])
            size = np.diff(first)
            counts = tables["word"][1][np.searchsorted(tables["word"][0], hashes)] if len(hashes) else np.zeros(0, np.int64)
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[first])  # noqa: E731,B023
            out["n_tokens"].append(size + 1)
            out["n_known"].append(sums(counts > 0) + (n_train > 0))
            out["base_score"].append(sums(np.log10(counts + 1.0) - rest) + np.log10(n_train + 1.0) - rest)
        made = {k: np.concatenate(v) for k, v in out.items()}
        return pa.table({
            "doc_id": docs.column("doc_id"), "train": docs.column("train"),
            **{k: pa.array(v, pa.float64() if "score" in k else pa.int64()) for k, v in made.items()}})

    return score


# ---- the operator ----------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HOLD_OUT)) == HELD, F.lit(False))


def score_documents(docs: DataFrame, learn: Column) -> DataFrame:
    """Scores of every whole text of ``docs`` (doc_id, text) under models learned from rows where ``learn``.

    Returns doc_id, train, n_tokens, n_known, train_tokens, base_score, score, n_bytes and
    bits_per_byte. ``score`` is the log10 probability of the canonical text (words in lower case, one
    blank between them, an end): each byte is eight binary choices, each choice has a tree of
    contexts of up to DEPTH bytes, and Krichevsky-Trofimov estimates of all depths are weighted by
    what they have made of the training texts. ``base_score`` is a unigram of words with one added.

    Documents are dealt to blocks. A block asks about each gram and word that it has, once, and
    adds its training counts to the question; shards of grams and words sum these over the whole
    corpus and answer each block. So no model is broadcast: what a task holds is bounded by its block's
    own text, or by its shard. Only the nodes of no and one byte of context, at most
    65,536, pass through the driver.

    A null or empty text is the end alone. Rows with a null or repeated doc_id are scored each. An
    empty table gives no rows. Extra columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"], docs["text"], F.coalesce(learn, F.lit(False)).alias("train"))
    facts = rows.agg(F.sum(F.octet_length("text")), F.sum(F.col("train").cast("long"))).first()
    volume, n_train = facts[0] or 0, facts[1] or 0
    n_blocks = max(shuffles(spark), -(-volume // BLOCK_BYTES))
    shards = max(shuffles(spark), -(-volume // 20 // SHARD_ENTRIES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n_blocks)).cast("int"))
    asked = stash(dealt.groupBy("block").applyInArrow(_asker(shards), _MESSAGE), "questions")
    about = lambda kind: asked.where(F.col("kind") == kind)
    words = stash(about("word").groupBy("shard").applyInArrow(_count_words, _MESSAGE), "word-answers")
    totals = np.zeros(2, dtype=np.int64)
    for row in words.where("block = -1").select("numbers").toLocalIterator():
        totals += np.frombuffer(row["numbers"], dtype="<i8")
    tops = about("gram").groupBy("shard").applyInArrow(_sum_tops, "c double, q double, n0 double, n1 double, below double")
    sums = tops.groupBy("c", "q").agg(*[F.sum(x).alias(x) for x in ("n0", "n1", "below")])
    top = Top(np.array([tuple(r) for r in sums.collect()], dtype=float).reshape(-1, 5))

    def answer(group: pa.Table) -> pa.Table:
        questions, keys, counts = _messages(group)
        return _answers(group, questions, keys, log10_bytes(keys, counts, top))

    answered = about("gram").groupBy("shard").applyInArrow(answer, _MESSAGE)
    answers = answered.unionByName(words.where("block >= 0"))
    n_words, n_tokens = int(totals[0]) + (n_train > 0), int(totals[1]) + n_train
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scorer(n_words, n_tokens, n_train),
        "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return scored.select(
        "doc_id", "train", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        "n_bytes", (-F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"))


def op2_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored, learning from those whose crc32(doc_id) mod 7 is not 2."""
    docs = require(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id", "text"])
    scored = score_documents(docs, ~held_out(F.col("doc_id")))
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "n_bytes", "bits_per_byte")
