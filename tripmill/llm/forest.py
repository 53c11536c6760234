"""Nearest neighbours by a forest of random-projection trees with one priority queue."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import require, stash
from tripmill.llm.vectors import blocks, dump, load, matrix, usable

NEIGHBOURS, QUERY_STEP = 20, 20
#: Rows of one forest, and queries that meet it in one task.
SHARD_ROWS, ASKED_ROWS = 8192, 4096
TREES, LEAF = 12, 32
#: Share of a forest's rows that a query takes from the queue at first, and by how much it grows while an audit fails.
FIRST_SHARE, WIDER = 0.05, 1.3
#: Queries of a task that are audited, and the recall that they must show.
AUDITED, RECALL = 64, 0.92


class Forest:
    """Trees over the rows of a matrix. A node is split by a hyperplane; negative children are leaves.

    ``normals`` has a row per inner node, ``offsets`` and ``children`` go with it, ``leaves`` lists
    rows, and ``roots`` has a node per tree.
    """

    def __init__(self, normals, offsets, children, leaves, roots):
        self.normals, self.offsets, self.children, self.leaves, self.roots = normals, offsets, children, leaves, roots

    @classmethod
    def build(cls, x: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 5) -> Forest:
        rng = np.random.default_rng(seed)
        normals, offsets, children, leaves, roots = [], [], [], [], []

        def put(rows: np.ndarray) -> int:
            if len(rows) <= leaf:
                leaves.append(rows)
                return -len(leaves)
            a, b = x[rng.choice(rows, 2, replace=False)]
            normal = a - b
            size = np.linalg.norm(normal)
            normal = normal / size if size > 0 else rng.standard_normal(x.shape[1])
            side = x[rows] @ normal
            offset = (a + b) @ normal / 2
            right = side > offset
            if not 0.1 < right.mean() < 0.9:
                # A lopsided cut: halve by the median instead, ties by place.
                order = np.argsort(side, kind="stable")
                right = np.zeros(len(rows), dtype=bool)
                right[order[len(rows) // 2:]] = True
                offset = side[order[len(rows) // 2]]
            at = len(normals)
            normals.append(normal)
            offsets.append(offset)
            children.append(None)
            children[at] = (put(rows[~right]), put(rows[right]))
            return at

        for _ in range(trees if len(x) > leaf else 1):
            roots.append(put(np.arange(len(x))))
        shape = (-1, x.shape[1])
        return cls(np.asarray(normals, dtype=np.float32).reshape(shape), np.asarray(offsets, dtype=np.float32), children, leaves, roots)

    def _paths(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(inner nodes of each depth, nodes' children, each row's leaf in every tree). A leaf's number follows those of the inner nodes."""
        inner = len(self.children)
        below = np.asarray([[c if c >= 0 else inner - c - 1 for c in two] for two in self.children], dtype=np.int64).reshape(-1, 2)
        levels, level = [], np.asarray([r for r in self.roots if r >= 0], dtype=np.int64)
        while len(level):
            levels.append(level)
            level = below[level].ravel()
            level = level[level < inner]
        rows = np.concatenate(self.leaves).reshape(len(self.roots), -1)
        leaf_of = np.empty_like(rows)
        numbers = np.repeat(inner + np.arange(len(self.leaves)), [len(x) for x in self.leaves])
        leaf_of[np.arange(len(rows))[:, None], rows] = numbers.reshape(rows.shape)
        return levels, below, leaf_of

    def _tied(self, worst: np.ndarray, margin: np.ndarray, below: np.ndarray, last: np.float32, taken: np.ndarray, most: int) -> None:
        """Take leaves whose worst margin is ``last``, as the queue comes to them, until ``most`` rows are taken."""
        inner = len(self.children)
        if last == -np.inf:
            queue = [*self.roots]
        else:
            parents, side = np.nonzero((worst[below] == last) & (worst[:inner, None] < last))
            queue = [self.children[p][s] for p, s in zip(parents.tolist(), side.tolist(), strict=True)]
        heapq.heapify(queue)
        n = np.count_nonzero(taken)
        while n < most:
            node = heapq.heappop(queue)
            while node >= 0:
                m = margin[node]
                left, right = self.children[node]
                near, far = (right, left) if m > 0 else (left, right)
                if max(last, abs(m)) == last:
                    heapq.heappush(queue, far)
                node = near
            rows = self.leaves[-node - 1]
            # A row in several trees' leaves counts once.
            n += len(rows) - np.count_nonzero(taken[rows])
            taken[rows] = True

    def candidates(self, queries: np.ndarray, most: int) -> Iterator[np.ndarray]:
        """At least ``most`` rows for each query: leaves in the order of their worst margin on the way, over all trees at once.

        The margins of all ways are worked out together, a depth at a time; leaves before the last worst margin that the
        queue comes to are taken by a comparison, so that only leaves of that very margin pass through the queue.
        """
        levels, below, leaf_of = self._paths()
        most = min(most, leaf_of.shape[1])
        for at in range(0, len(queries), 128):
            margins = np.ascontiguousarray((queries[at:at + 128].astype(np.float32) @ self.normals.T - self.offsets).T)
            worst = np.full((len(self.children) + len(self.leaves), margins.shape[1]), -np.inf, dtype=np.float32)
            for level in levels:
                m, near = margins[level], worst[level]
                far = np.maximum(near, np.abs(m))
                worst[below[level, 0]] = np.where(m > 0, far, near)
                worst[below[level, 1]] = np.where(m > 0, near, far)
            for own, margin in zip(np.ascontiguousarray(worst.T), np.ascontiguousarray(margins.T), strict=True):
                first = own[leaf_of].min(axis=0)
                last = np.partition(first, most - 1)[most - 1]
                taken = first < last
                self._tied(own, margin, below, last, taken, most)
                yield np.flatnonzero(taken)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) > k:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))][:k]


def _forests(longest: float):
    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for raw in batch.column("data"):
                own = load(raw)
                x = own["vectors"]
                # One dimension more makes all vectors equally long, so that the largest inner product is the nearest.
                rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
                forest = Forest.build(np.column_stack([x, rest]))
                made.append(dump(id=own["id"], vectors=x, forest=forest.__dict__))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["dim", "shard"]).columns, pa.array(made, pa.binary())], ["dim", "shard", "forest"])

    return build


def search(
    forest: Forest, x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
) -> tuple[list[tuple[np.ndarray, np.ndarray]], float]:
    """For each query the ids and inner products of its k best rows of ``x``; and the share of rows that queries took.

    Some queries are audited by brute force. All take rows from the forest, more of them until the audited ones show the
    recall; only if that takes nearly all rows are queries compared with every one.
    """
    lifted = np.column_stack([queries, np.zeros(len(queries))])
    audited = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))

    def nearest(r: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = rows[ids[rows] != query_ids[r]]
        scores = x[rows] @ queries[r]
        best = _best(scores, ids[rows], k)
        return ids[rows][best], scores[best]

    every = np.arange(len(x))
    truth = {r: nearest(r, every) for r in audited}
    wanted = sum(len(t[0]) for t in truth.values())
    most = max(2 * k, int(FIRST_SHARE * len(x)))
    while most < 0.9 * len(x):
        found = {r: nearest(r, rows) for r, rows in zip(audited, forest.candidates(lifted[audited], most), strict=True)}
        if sum(len(np.intersect1d(found[r][0], truth[r][0])) for r in audited) >= RECALL * wanted:
            taken, out = 0, []
            for r, rows in enumerate(forest.candidates(lifted, most)):
                taken += len(rows)
                out.append(truth[r] if r in truth else nearest(r, rows))
            return out, taken / max(1, len(queries) * len(x))
        most = int(WIDER * most)
    return [truth.get(r) or nearest(r, every) for r in range(len(queries))], 1.0


def _searcher(k: int):
    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, asks, near, scores = [], [], [], []
        if left.num_rows and right.num_rows:
            f = load(left.column("forest")[0])
            right = right.sort_by([("id", "ascending"), ("ask", "ascending")])
            query_ids = right.column("id").to_numpy()
            best, _ = search(Forest(**f["forest"]), f["vectors"], f["id"], matrix(right.column("vector")), query_ids, k)
            n = [len(v[0]) for v in best]
            ids, asks = np.repeat(query_ids, n), np.repeat(right.column("ask").to_numpy(), n)
            near, scores = np.concatenate([v[0] for v in best]), np.concatenate([v[1] for v in best])
        return pa.table([pa.array(ids, pa.int64()), pa.array(asks, pa.int64()), pa.array(near, pa.int64()), pa.array(scores, pa.float64())],
                        ["query_id", "ask", "vec_id", "score"])

    return found


def nearest_neighbours(embeddings: DataFrame, is_query: Column, k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows where ``is_query``, the k rows of largest inner product.

    ``embeddings`` has vec_id and embedding. Every row is indexed, in shards of about SHARD_ROWS with a forest each. Queries are
    dealt to every shard in parts of about ASKED_ROWS, and a forest travels once per part. Queries take
    candidates through one priority queue over all trees of a shard, and rank them by the inner product of the
    original vectors in double precision. A part audits some queries by brute force and takes more candidates
    until they show the recall. The best of all shards are kept, nearest first, ties to the smaller vec_id.

    A query's own vec_id is no candidate of it. Vectors that are null, empty, zero or hold a null or
    non-finite component, and rows with a null vec_id, take no part. Vectors of another dimension
    are no candidates. Rows that repeat a vec_id are candidates each; as queries, equal rows ask once, and different
    vectors of one vec_id each have ranks of their own. An empty table gives no rows. Extra columns are left out.
    """
    rows = embeddings.select(
        embeddings["vec_id"].cast("long").alias("id"), embeddings["embedding"].alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    facts = rows.agg(F.count("*"), F.sum(F.col("asks").cast("long")), F.max(square)).first()
    shards = max(1, -(-facts[0] // SHARD_ROWS))
    salts = max(1, -(-(facts[1] or 0) // ASKED_ROWS))
    own = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    forests = stash(blocks(own, ["dim"], "shard").mapInArrow(
        _forests(float(facts[2] or 0)), "dim int, shard int, forest binary"), "forests")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    parted = forests.withColumn("salt", numbers(salts))
    asked = rows.where("asks").select("dim", "id", F.xxhash64("vector").alias("ask"), "vector").dropDuplicates(["id", "ask"])
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(salts)).cast("int")).withColumn("shard", numbers(shards))
    keys = ["dim", "shard", "salt"]
    found = parted.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        _searcher(k), "query_id long, ask long, vec_id long, score double")
    order = Window.partitionBy("query_id", "ask").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op10_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every embedding whose vec_id is divisible by 20."""
    vectors = require(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), ["vec_id", "embedding"])
    return nearest_neighbours(vectors, F.col("vec_id") % QUERY_STEP == 0)
