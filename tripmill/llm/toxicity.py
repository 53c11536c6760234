"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import require, stash

#: Labelled examples at most, half of either label, and the terms that they are compared by: bounds of the index, which is broadcast.
EXAMPLES, TERMS = 6000, 1000
#: A term tells the labels apart by so much (chi squared, one degree of freedom) at least.
TELLING = 20.0
NEIGHBOURS, BLOCK = 31, 64
#: A neighbour votes by this power of its cosine; so much of a vote is for the share of toxic texts in general.
POWER, DOUBT = 3, 0.3
CUT, FOLDS, HELD_OUT = 0.7, 3, 1
SHOWN = 3

# Bytes of words are a-z, A-Z (folded), 0-9 and all of 128 and more.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> Counter:
    """How often each word of a whole text occurs."""
    return Counter(text.translate(_WORDS).split())


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column("text").cast(pa.large_binary()):
        yield text.as_py() or b""


# ---- the index -------------------------------------------------------------------------------

class BlockMax:
    """Inverted lists of unit vectors in blocks of successive examples, with the largest weight of each term in each block.

    ``rows`` and ``weights`` hold the postings by term, then example; those of term t in block b lie
    from ``start[t, b]`` to ``start[t, b + 1]``; ``top[t, b]`` is their largest weight.
    """

    def __init__(self, vectors: list[dict[int, float]], n_terms: int):
        # Neighbours in the order share their heaviest terms, so that a block holds much of few terms.
        heavy = [tuple(sorted(v, key=lambda t, v=v: (-v[t], t))[:3]) for v in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda i: (heavy[i], i)), dtype=np.int64)
        self.n, self.blocks = len(vectors), max(1, -(-len(vectors) // BLOCK))
        place = np.empty(self.n, dtype=np.int64)
        place[self.order] = np.arange(self.n)
        posts = sorted((t, int(place[i]), w) for i, v in enumerate(vectors) for t, w in v.items())
        term = np.array([p[0] for p in posts], dtype=np.int64)
        self.rows = np.array([p[1] for p in posts], dtype=np.int64)
        self.weights = np.array([p[2] for p in posts], dtype=np.float64)
        cell = term * self.blocks + self.rows // BLOCK
        bounds = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1))
        self.first, self.last = (b.reshape(n_terms, self.blocks) for b in (bounds[:-1], bounds[1:]))
        self.top = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.top, cell, self.weights)
        self.top = self.top.reshape(n_terms, self.blocks)

    def nearest(self, query: dict[int, float], k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """(examples, cosines, blocks read): the k of largest cosine above 0, ties to the smaller example.

        A block's bound is the sum of the query's weights times the block's largest. Blocks are read
        from the largest bound down, until the k-th cosine found is above all bounds left.
        """
        none = np.zeros(0, dtype=np.int64), np.zeros(0), 0
        if not query:
            return none
        terms = np.fromiter(query, np.int64, len(query))
        own = np.fromiter(query.values(), np.float64, len(query))
        bound = own @ self.top[terms] * (1 + 1e-9)
        by = np.argsort(-bound, kind="stable")
        by = by[:np.count_nonzero(bound)]
        ids, cosines = np.zeros(0, dtype=np.int64), np.zeros(0)
        at, step = 0, 2
        while at < len(by) and (len(ids) < k or bound[by[at]] >= cosines[-1]):
            chosen = by[at:at + step]
            begin, size = self.first[terms][:, chosen].ravel(), (self.last - self.first)[terms][:, chosen].ravel()
            at, step = at + len(chosen), 2 * step
            ends = np.cumsum(size)
            where = np.arange(ends[-1]) + np.repeat(begin - ends + size, size)
            rows, inverse = np.unique(self.rows[where], return_inverse=True)
            found = np.bincount(inverse, self.weights[where] * np.repeat(np.repeat(own, len(chosen)), size))
            new = self.order[rows]
            if without >= 0:
                new, found = new[new != without], found[new != without]
            ids, cosines = np.concatenate([ids, new]), np.concatenate([cosines, found])
            best = np.lexsort((ids, -cosines))[:k]
            ids, cosines = ids[best], cosines[best]
        return ids, cosines, at


@dataclass
class Judge:
    """Labelled examples, their index, and how votes become probabilities."""

    terms: dict[bytes, int]
    idf: np.ndarray
    index: BlockMax
    toxic: np.ndarray
    names: np.ndarray
    share: float
    votes: np.ndarray
    chances: np.ndarray

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        return unit(counts, self.idf)

    def counts(self, text: bytes) -> dict[int, int]:
        """How often a whole text holds each of the index's terms."""
        known = self.terms
        return Counter([known[w] for w in text.translate(_WORDS).split() if w in known])

    def vote(self, ids: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic among the neighbours, the nearer the heavier."""
        weight = cosines ** POWER
        return float((weight @ self.toxic[ids] + DOUBT * self.share) / (weight.sum() + DOUBT))

    def score(self, vote: float) -> float:
        return float(np.interp(vote, self.votes, self.chances))


def unit(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    """Logarithmic term frequency times idf, of length one."""
    raw = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items()}
    size = math.sqrt(sum(x * x for x in raw.values()))
    return {t: x / size for t, x in raw.items()} if size else {}


def calibrate(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (votes, chances) of the monotone step function that fits best, straight lines between its steps.

    Neighbouring votes are pooled while their share of toxic falls (weighted); half a text of either label
    is added to each pool, so that no chance is 0 or 1.
    """
    pools: list[list[float]] = []
    for i in np.lexsort((toxic, votes)):
        pools.append([weight[i] * toxic[i], weight[i], votes[i], votes[i]])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    chances = np.maximum.accumulate(np.array([(t + 0.5 * min(1.0, n / 10)) / (n + min(1.0, n / 10)) for t, n, _, _ in pools]))
    return np.array([v for _, _, a, b in pools for v in (a, b)]), np.repeat(chances, 2)


# ---- learning --------------------------------------------------------------------------------

def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def _examples(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, int]]:
    """(name, toxic, text) of the chosen training texts, and how many distinct training texts have each label.

    Equal texts are one, with the label that most of them have. Of each label those of smallest digest are chosen.
    """
    own = docs.select(F.col("doc_id").alias("name"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    told = labels.where(F.col("toxic").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    seen = told.join(own, told["doc_id"] == own["name"]).groupBy("digest").agg(
        F.min("name").alias("name"), (F.avg("toxic") > 0.5).cast("int").alias("toxic"))
    seen = stash(seen, "toxicity-labels")
    sizes = {r["toxic"]: r["count"] for r in seen.groupBy("toxic").count().collect()}
    chosen = [seen.where(F.col("toxic") == side).orderBy("digest").limit(most // 2) for side in (0, 1)]
    # At most ``most`` rows of three short columns.
    few = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    found = texts.join(few, (texts["doc_id"] == few["name"]) & (texts["digest"] == few["digest"]))
    return found.select("name", "toxic", "text"), sizes


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, term, n = [], [], []
        for i, text in enumerate(_texts(batch)):
            counts = terms_of(text)
            row += [i] * len(counts)
            term += counts
            n += counts.values()
        take = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("name").take(take), batch.column("toxic").take(take), pa.array(term, pa.binary()), pa.array(n, pa.int64())],
            ["name", "toxic", "term", "n"])


def _telling(counted: DataFrame, sizes: tuple[int, int], telling: float, most: int) -> DataFrame:
    """The terms (at most ``most``) whose presence in an example depends most on its label."""
    clean, toxic = (F.lit(float(n)) for n in sizes)
    per = counted.groupBy("term").agg(F.sum(F.col("toxic").cast("double")).alias("a"), F.count("*").cast("double").alias("m"))
    b = F.col("m") - F.col("a")
    total = clean + toxic
    gap = F.col("a") * (clean - b) - b * (toxic - F.col("a"))
    chi = F.try_divide(total * gap * gap, F.col("m") * (total - F.col("m")) * clean * toxic)
    return per.select("term", chi.alias("chi")).where(F.col("chi") >= telling).orderBy(F.col("chi").desc(), "term").limit(most)


def _document_counts(docs: DataFrame, terms: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many hold each term. A task sends one row per term that it met."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(len(terms), dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for text in _texts(batch):
                held[[terms[w] for w in set(text.translate(_WORDS).split()) & terms.keys()]] += 1
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], met]).astype(np.int32)), pa.array(np.concatenate([[n], held[met]]))], ["term", "n"])

    summed = require(docs, ["text"]).mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in summed}
    return found.get(-1, 0), np.array([found.get(t, 0) for t in range(len(terms))], dtype=np.float64)


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, most_terms: int = TERMS, telling: float = TELLING) -> Judge:
    """A judge from the labels outside the held-out fold. ``docs`` has doc_id and text, ``labels`` doc_id and toxic."""
    docs, labels = require(docs, ["doc_id", "text"]), require(labels, ["doc_id", "toxic"])
    chosen, sizes = _examples(docs, labels, examples)
    schema = f"name {dict(docs.dtypes)['doc_id']}, toxic int, term binary, n long"
    # Repeated rows of a text are one example.
    counted = stash(chosen.dropDuplicates(["name", "text"]).mapInArrow(_counted, schema), "toxicity-examples")
    known = {side: min(n, examples // 2) for side, n in sizes.items()}
    told = stash(_telling(counted, (known.get(0, 0), known.get(1, 0)), telling, most_terms), "toxicity-terms")
    terms = {bytes(r["term"]): i for i, r in enumerate(told.orderBy("term").collect())}
    n_docs, held = _document_counts(docs, terms)
    idf = np.log((1 + n_docs) / (1 + held)) + 1e-9
    # At most ``examples`` times ``most_terms`` small rows; an example without any of the terms has no vector.
    vectors: dict = {}
    for r in counted.join(F.broadcast(told.select("term")), "term", "left_semi").collect():
        vectors.setdefault((r["name"], r["toxic"]), {})[terms[bytes(r["term"])]] = r["n"]
    keys = sorted(vectors, key=lambda key: str(sorted(vectors[key].items())) + str(key))
    units = [unit(vectors[key], idf) for key in keys]
    toxic = np.array([key[1] for key in keys], dtype=np.float64)
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    judge = Judge(terms, idf, BlockMax(units, len(terms)), toxic, np.array([key[0] for key in keys], dtype=np.int64), share, np.zeros(1), np.array([share]))
    if known:
        # Each example is judged by the others; examples stand for all training texts of their label.
        votes = np.array([judge.vote(*judge.index.nearest(u, NEIGHBOURS, without=i)[:2]) for i, u in enumerate(units)])
        bare = {side: n - int((toxic == side).sum()) for side, n in known.items()}
        votes = np.concatenate([votes, *(np.full(n, judge.vote(np.zeros(0, int), np.zeros(0))) for n in bare.values())])
        truth = np.concatenate([toxic, *(np.full(n, float(side)) for side, n in bare.items())])
        weight = np.array([sizes[int(t)] / known[int(t)] for t in truth])
        judge.votes, judge.chances = calibrate(votes, truth, weight)
    return judge


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT, examples: int = EXAMPLES, terms: int = TERMS, telling: float = TELLING) -> DataFrame:
    """``docs`` with score (double, 0 to 1), predicted (int) and evidence (the nearest toxic examples, by doc_id).

    Training texts are those with a label whose doc_id is not in the held-out fold; equal texts are one.
    At most ``examples`` of them (half of either label, by a digest of the text) are indexed, by at most
    ``terms`` words whose presence tells the labels apart; document frequencies of these are counted over all
    documents. The index is thereby bounded by ``examples`` x ``terms`` postings, and is broadcast.

    A text's nearest examples by TF-IDF cosine are found exactly: blocks of examples are read in the order of
    the bounds that their largest weights give, until no other block can hold a nearer one. Neighbours vote
    by a power of their cosine; votes become probabilities by a monotone fit on the examples, each
    judged by the others. ``predicted`` is 1 from ``cut`` on. Only words count; no other column is read.

    A null or empty text, and one without any of the words, has no neighbours and the score of such texts. Labels
    other than 0 and 1, labels without a document and null doc_ids are not learned from; conflicting labels of equal texts
    go by the majority, ties to 0. Without labels all scores are 0. Repeated rows are scored each. An empty
    table gives no rows. Extra columns stay; those named like a result are refused.
    """
    if clash := [c for c in docs.columns if c.lower() in {"score", "predicted", "evidence"}]:
        raise ValueError(f"columns clash with the result: {clash}")
    judge = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, examples, terms, telling))

    @F.arrow_udf("struct<score: double, evidence: array<bigint>>")
    def judged(column: pa.Array) -> pa.Array:
        own = judge.value
        scores, evidence = [], []
        for text in column.cast(pa.large_binary()):
            ids, cosines, _ = own.index.nearest(own.vector(own.counts(text.as_py() or b"")), NEIGHBOURS)
            scores.append(own.score(own.vote(ids, cosines)))
            evidence.append(own.names[ids[own.toxic[ids] == 1][:SHOWN]].tolist())
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], ["score", "evidence"])

    names = [docs[c] for c in docs.columns]
    scored = docs.select(*names, judged(docs["text"]).alias("_judged"))
    return scored.select(
        *[scored[c] for c in docs.columns], F.col("_judged.score").alias("score"),
        (F.col("_judged.score") >= cut).cast("int").alias("predicted"), F.col("_judged.evidence").alias("evidence"))


def op13_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, score, predicted, evidence."""
    docs = require(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id", "text"])
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")
