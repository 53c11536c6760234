"""Embedding near-dedup by hierarchical navigable small-world graphs, one per shard."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import connected, require, stash
from tripmill.llm.vectors import blocks, dump, load, matrix, usable

THRESHOLD = 0.93
#: Vectors of one graph, queries that meet it in one task, and those that are searched and audited together.
SHARD_ROWS, ASKED_ROWS, BLOCK_ROWS = 8192, 4096, 1024
#: Links per node (twice as many on the ground layer), and the beam when building.
LINKS, BUILD_BEAM = 12, 48
#: First beam of a search, queries that each block audits by brute force, and the recall these must show.
BEAM, AUDITED, RECALL = 48, 48, 0.99
_WIDTH = 4


# ---- the graph -------------------------------------------------------------------------------

class SmallWorld:
    """A layered graph over unit vectors. ``layers``: (members, links) from the ground up.

    ``links`` of a layer has a row per vector of the shard, -1 where a place is free.
    """

    def __init__(self, units: np.ndarray, layers: list[np.ndarray], entry: int):
        self.units, self.layers, self.entry = units, layers, entry

    @classmethod
    def build(cls, units: np.ndarray, seed: int = 7) -> SmallWorld:
        n = len(units)
        rng = np.random.default_rng(seed)
        height = np.minimum((-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(int), 4)
        order = rng.permutation(n)
        order = np.concatenate([order[[np.argmax(height[order])]], np.delete(order, np.argmax(height[order]))])
        top = int(height.max(initial=0))
        layers = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, dtype=np.int32) for k in range(top + 1)]
        graph = cls(units, layers, int(order[0]))
        done = 1
        while done < n:
            batch = order[done:done + min(max(32, done), 1024)]
            graph._add(batch, height)
            done += len(batch)
        return graph

    def _add(self, batch: np.ndarray, height: np.ndarray) -> None:
        """Link a batch: to what a search of the graph so far finds, and to each other."""
        queries = self.units[batch]
        near = np.full((len(batch), 1), self.entry)
        found = {}
        for k in range(len(self.layers) - 1, -1, -1):
            near, _ = self._search(queries, near, k, BUILD_BEAM if (height[batch] >= k).any() else 1)
            found[k] = near
        among = queries @ queries.T
        np.fill_diagonal(among, -2)
        for k, links in enumerate(self.layers):
            own = np.flatnonzero(height[batch] >= k)
            if not len(own):
                break
            peers = among[np.ix_(own, own)]
            m = min(LINKS, len(own) - 1)
            mates = batch[own][np.argpartition(-peers, m - 1, axis=1)[:, :m]] if m > 0 else np.zeros((len(own), 0), int)
            near = np.concatenate([found[k][own], mates], axis=1)
            self._choose(links, batch[own], near)
            # Each chosen node gets the link back, and keeps its most useful ones.
            left = np.repeat(batch[own], links.shape[1])
            right = links[batch[own]].ravel()
            left, right = left[right >= 0], right[right >= 0]
            order = np.argsort(right, kind="stable")
            left, right = left[order], right[order]
            nodes, start, size = np.unique(right, return_index=True, return_counts=True)
            size = np.minimum(size, 4 * links.shape[1])
            back = np.full((len(nodes), size.max(initial=0)), -1)
            for j in range(back.shape[1]):
                has = size > j
                back[has, j] = left[start[has] + j]
            self._choose(links, nodes, np.concatenate([links[nodes], back], axis=1))

    def _choose(self, links: np.ndarray, nodes: np.ndarray, near: np.ndarray) -> None:
        """Set the links of nodes: near ones first, leaving out those nearer to a chosen link than to the node."""
        most = links.shape[1]
        for at in range(0, len(nodes), 256):
            own, cand = nodes[at:at + 256], near[at:at + 256]
            cand = np.where(cand == own[:, None], -1, cand)
            sims = np.einsum("ijk,ik->ij", self.units[cand], self.units[own])
            sims[cand < 0] = -2
            order = np.argsort(-sims, axis=1, kind="stable")
            cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
            cand, sims = cand[:, :3 * most], sims[:, :3 * most]
            again = np.zeros(cand.shape, dtype=bool)
            by = np.argsort(cand, axis=1, kind="stable")
            same = np.diff(np.take_along_axis(cand, by, 1), axis=1) == 0
            np.put_along_axis(again[:, :], by[:, 1:], same, 1)
            sims[again | (cand < 0)] = -2
            vectors = self.units[cand]
            between = np.einsum("ijk,ilk->ijl", vectors, vectors)
            taken = np.zeros(cand.shape, dtype=bool)
            for j in range(cand.shape[1]):
                worst = np.where(taken, between[:, j], -2).max(axis=1)
                taken[:, j] = (sims[:, j] > -2) & (worst < sims[:, j]) & (taken.sum(axis=1) < most)
            # Free places go to the nearest of those left out.
            rank = np.where(taken, 0, 1) + np.where(sims > -2, 0, 2)
            best = np.argsort(rank, axis=1, kind="stable")[:, :most]
            picked = np.take_along_axis(np.where(sims > -2, cand, -1), best, 1)
            links[own] = -1
            links[own[:, None], np.arange(picked.shape[1])[None]] = picked

    def _search(self, queries: np.ndarray, starts: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of each query's beam on one layer, -1 where it isn't full; all queries step together."""
        links, b = self.layers[layer], len(queries)
        seen = np.zeros((b, len(self.units) + 1), dtype=bool)
        row = np.arange(b)[:, None]
        seen[row, starts] = True
        ids = np.full((b, beam), -1)
        sims = np.full((b, beam), -2.0, dtype=np.float32)
        first = np.where(starts >= 0, np.einsum("ijk,ik->ij", self.units[starts], queries), -2)
        top = np.argsort(-first, axis=1)[:, :beam]
        ids[:, :top.shape[1]] = np.take_along_axis(starts, top, 1)
        sims[:, :top.shape[1]] = np.take_along_axis(first, top, 1)
        todo = sims > -2
        live = np.arange(b)
        # Wide beams expand many nodes at once, so that steps don't grow with the beam.
        width = min(max(_WIDTH, beam // 8), beam)
        while len(live):
            masked = np.where(todo[live], sims[live], -3)
            pick = np.argpartition(-masked, width - 1, axis=1)[:, :width] if beam > width else np.argsort(-masked, axis=1)
            some = np.take_along_axis(masked, pick, 1) > -3
            go = some.any(axis=1)
            live, pick, some = live[go], pick[go], some[go]
            if not len(live):
                break
            at = live[:, None]
            nodes = np.where(some, ids[at, pick], -1)
            todo[at, pick] = False
            near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            new = (near >= 0) & ~seen[at, near]
            seen[at, near] = True
            near = np.where(new, near, -1)
            got = np.einsum("ijk,ik->ij", self.units[near], queries[live], optimize=False)
            got[~new] = -2
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_sims = np.concatenate([sims[live], got], axis=1)
            all_todo = np.concatenate([todo[live], new], axis=1)
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, 1)
            sims[live] = np.take_along_axis(all_sims, best, 1)
            todo[live] = np.take_along_axis(all_todo, best, 1)
        return np.where(sims > -2, ids, -1), sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        near = np.full((len(queries), 1), self.entry)
        for k in range(len(self.layers) - 1, 0, -1):
            near, _ = self._search(queries, near, k, 1)
        # The entry starts as well, so that the widest beam finds all that can be reached from it.
        return self._search(queries, np.concatenate([near, np.where(near == self.entry, -1, self.entry)], axis=1), 0, beam)

    def unreached(self) -> np.ndarray:
        """Nodes that no walk of the ground layer from the entry comes to: pruned links may leave a node without an inbound one."""
        links = self.layers[0]
        reached = np.zeros(len(self.units), dtype=bool)
        front = np.array([self.entry])
        while len(front):
            reached[front] = True
            near = np.unique(links[front])
            near = near[near >= 0]
            front = near[~reached[near]]
        return np.flatnonzero(~reached)


def links_at(graph: SmallWorld, exact: np.ndarray, queries: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(query row, nodes with cosine of at least ``threshold``) of a block, self included.

    ``exact`` and ``queries`` are unit vectors in double precision. A query whose beam holds
    nothing below the threshold, and a block whose audit falls short, are searched again with a
    beam four times as wide. Nodes that no search can reach are compared with every query, and a
    block whose audit falls short at the widest beam is compared with all nodes.
    """
    rows, beam, n = np.arange(len(queries)), BEAM, len(exact)
    low = queries.astype(np.float32)
    audited = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))
    truth = queries[audited] @ exact.T >= threshold
    hits: dict[int, np.ndarray] = {}
    lost = graph.unreached()
    while len(rows):
        beam = min(beam, n)
        again = []
        # A step gathers the neighbours of all nodes that it expands: 32 MB of them at most.
        gathered = 2 * LINKS * max(_WIDTH, beam // 8) * exact.shape[1]
        step = max(4, min(512, (1 << 21) // beam, (1 << 23) // n, (1 << 23) // gathered))
        for at in range(0, len(rows), step):
            own = rows[at:at + step]
            nodes, sims = graph.search(low[own], beam)
            full = (sims.min(axis=1) >= threshold - 1e-3) if beam < n else np.zeros(len(own), dtype=bool)
            beside = queries[own] @ exact[lost].T >= threshold
            for i, r in enumerate(own):
                near = nodes[i][sims[i] >= threshold - 1e-4]
                hits[r] = near[exact[near] @ queries[r] >= threshold]
                if len(lost):
                    hits[r] = np.union1d(hits[r], lost[beside[i]])
                if full[i]:
                    again.append(r)
        held = sum(len(hits[r]) for r in audited)
        if held < RECALL * truth.sum():
            if beam == n:
                # No beam is wider: the block is compared with all nodes.
                for at in range(0, len(queries), 128):
                    for r, linked in enumerate(queries[at:at + 128] @ exact.T >= threshold, at):
                        hits[r] = np.flatnonzero(linked)
                break
            # The audit fails: all queries get the wider beam.
            again = np.arange(len(queries))
        if beam == n:
            break
        rows, beam = np.asarray(again, dtype=int), 4 * beam
    for i, r in enumerate(audited):
        hits[r] = np.flatnonzero(truth[i])
    yield from hits.items()


# ---- the operator ----------------------------------------------------------------------------

def _graphs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for raw in batch.column("data"):
            own = load(raw)
            exact = own["vectors"] / np.linalg.norm(own["vectors"], axis=1, keepdims=True)
            graph = SmallWorld.build(exact.astype(np.float32))
            made.append(dump(id=own["id"], copies=own["copies"], exact=exact, layers=graph.layers, entry=graph.entry))
        keys = batch.select(["label", "dim", "salts", "shard"])
        yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(made, pa.binary())], [*keys.schema.names, "graph"])


def _finder(threshold: float):
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        """Rows (id, n_links, top): of each query its links in this graph, and of every node that they move its smallest one."""
        names = ["id", "n_links", "top"]
        if not left.num_rows or not right.num_rows:
            none = pa.array([], pa.int64())
            return pa.table([none, none, none], names)
        g = load(left.column("graph")[0])
        world = SmallWorld(g["exact"].astype(np.float32), g["layers"], g["entry"])
        right = right.sort_by("id")
        asked = right.column("id").to_numpy()
        queries = matrix(right.column("vector"))
        queries = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        ids = np.unique(np.concatenate([g["id"], asked]))
        parent = np.arange(len(ids))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        n_links = np.zeros(len(asked), dtype=np.int64)
        where, own = np.searchsorted(ids, g["id"]), np.searchsorted(ids, asked)
        for at in range(0, len(asked), BLOCK_ROWS):
            for r, near in links_at(world, g["exact"], queries[at:at + BLOCK_ROWS], threshold):
                r += at
                others = near[g["id"][near] != asked[r]]
                n_links[r] = g["copies"][others].sum()
                me = root(own[r])
                for other in where[others]:
                    other = root(other)
                    if other != me:
                        me, other = min(me, other), max(me, other)
                        parent[other] = me
        rest = np.setdiff1d(ids, asked)
        tops = ids[[root(x) for x in np.searchsorted(ids, rest)]] if len(rest) else rest
        moved = tops != rest
        return pa.table([
            pa.array(np.concatenate([asked, rest[moved]])), pa.array(np.concatenate([n_links, np.zeros(moved.sum(), np.int64)])),
            pa.array(np.concatenate([ids[[root(x) for x in own]], tops[moved]]))], names)

    return find


def near_dedup(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``embeddings`` (vec_id, embedding, label).

    Vectors of one label (and one dimension) link at a cosine of ``threshold`` or more, in double
    precision. Equal vectors are one node from the start, counted as often as they occur. A label's
    nodes are dealt to graphs of about SHARD_ROWS, and every node asks every graph of its label, in parts of
    about ASKED_ROWS that a graph travels to once. A task gives counts and one edge per node, never pairs;
    components come from these edges.

    Searches repeat with wider beams until each block's audit by brute force shows a recall of
    RECALL, and end with all pairs of the block if no beam does, so a link can be missed, but none
    below the threshold is made. Nodes that a graph's links don't lead to are compared directly.

    A null label, and a vector that is null, empty, zero or holds a null or non-finite component,
    links with nothing. A null vec_id takes no part and has a null component_id and kept false.
    Rows that repeat a vec_id count as vectors of their own under one node. An empty table gives no
    rows. Extra columns are left out.
    """
    rows = require(embeddings, ["vec_id", "embedding", "label"]).withColumn("vec_id", F.col("vec_id").cast("long"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    nodes = rows.where(ok).groupBy("label", F.col("embedding").alias("vector")).agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies")).withColumn("dim", F.size("vector"))
    nodes = stash(nodes, "vector-nodes")
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    parts = lambda rows: F.ceil(F.col("n") / rows).cast("int")
    dealt = nodes.join(sizes, ["label", "dim"]).select(
        "label", "dim", "vector", "id", "copies", parts(SHARD_ROWS).alias("shards"), parts(ASKED_ROWS).alias("salts"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))
    graphs = stash(blocks(dealt, ["label", "dim", "salts"], "shard", ["copies"]).mapInArrow(
        _graphs, f"label {dict(nodes.dtypes)['label']}, dim int, salts int, shard int, graph binary"), "graphs")
    keys = ["label", "dim", "shard", "salt"]
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = dealt.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), F.col("salts")).cast("int")).drop("shard").withColumn(
        "shard", numbers("shards")).select(*keys, "id", "vector")
    parted = graphs.withColumn("salt", numbers("salts")).select(*keys, "graph")
    met = parted.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_finder(threshold), "id long, n_links long, top long")
    found = stash(met, "vector-links")
    classes = connected(found.where("id <> top").select(F.col("id").alias("a"), F.col("top").alias("b")))
    counts = found.groupBy("id").agg(F.sum("n_links").alias("others"))
    result = nodes.join(counts, "id", "left").join(classes, F.col("id") == F.col("node"), "left").select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    plain = rows.withColumn("_ok", ok)
    joined = plain.join(result, F.col("_ok") & (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_vector")), "left")
    component = F.coalesce("c", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op1_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings: vec_id, n_links, component_id, kept."""
    return near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
