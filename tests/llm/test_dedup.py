"""Line dedup, Jaccard join and graph near-dedup against brute force, and their odd rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, differences
from tripmill.llm import common, hnsw, jaccard, lines

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _union(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def _shingles(text, n=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} - {()}
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def _brute_jaccard(rows):
    sets = {i: _shingles(t) for i, t in rows if i is not None}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {i: (len(s), c) for (i, s), c in zip(sets.items(), _union(sets, pairs).values(), strict=True)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(20, 60)] + [(5, 70), (70, 3), (8, 8), (60, 20)]
    found = {r.node: r.component for r in common.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 20 for i in range(20, 61)}, 3: 3, 5: 3, 70: 3}
    assert common.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = _brute_jaccard([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op7_jaccard_join(spark, SF).collect()}
    assert got == want


def test_jaccard_of_altered_copies_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 10_000, 120)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "One two"), (4, "one  TWO"), (5, "x " * 30_000)]
    for i in range(60):
        own = list(base)
        for at in rng.integers(0, len(own), rng.integers(0, 7)):
            own[at] = f"v{rng.integers(0, 10**6)}"
        rows.append((10 + i, " ".join(own)))
    rows += [(80 + i, " ".join(base[:40 + i])) for i in range(12)]
    docs = spark.createDataFrame([(i, t, i) for i, t in [*rows, (None, "one two")]], "doc_id long, text string, component_id long")
    out = jaccard.jaccard_join(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == _brute_jaccard(rows)
    assert [(r.n_shingles, r.component_id) for r in out if r.doc_id is None] == [(1, None)]
    assert jaccard.jaccard_join(docs.limit(0)).count() == 0


def test_line_dedup_equals_sql(spark):
    assert differences(lines.op5_line_dedup(spark, SF), connect(SF), lines.OP5_SQL) is None


def _cut(rows, least):
    held = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                held[key(x)].add(i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= least}
    return {i: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), i) == i) for i, t in rows}


LONG = "this line is well over forty code points long, it is"
ROWS = [(i, f"head {i}\n  {LONG.upper()}\t\n{LONG}\nend") for i in range(6)] + [(6, None), (7, ""), (8, "ä" * 39), (9, LONG + " ")]
ROWS += [(10 + i, "ä" * 40) for i in range(5)]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, shard int")


def test_line_index_can_be_undone(spark):
    first, more = ROWS[:4], ROWS[4:]
    index = lines.LineIndex.build(_frame(spark, first))
    texts = lambda x, rows: {r.doc_id: r.text for r in x.dedup(_frame(spark, rows)).collect()}
    assert texts(index, first) == {i: t for i, t in first}
    grown = index.insert(_frame(spark, more))
    assert texts(grown, ROWS) == _cut(ROWS, 5)
    back = grown.delete(_frame(spark, more).select("doc_id"))
    assert texts(back, first) == {i: t for i, t in first}
    whole = lines.LineIndex.build(_frame(spark, ROWS))
    table = lambda x: sorted(tuple(r) for r in x.refs.collect())
    assert table(grown) == table(whole) and table(back) == table(index)


def _lined(ids, step=7):
    return [(i, "\n".join(f"shared passage number {(i * k) % 60:04d} of many documents" for k in range(1, step))) for i in ids]


def test_small_changes_touch_their_own_keys(spark):
    """The base stays as it is, only the postings of changed documents are written, and counts equal a new build."""
    rows = {i: t for i, t in _lined(range(300))}
    index = lines.LineIndex.build(_frame(spark, rows.items()))
    base, old = index.base.inputFiles(), sorted(map(tuple, index.refs.collect()))
    rng = np.random.default_rng(11)
    new, known = 1000, index
    for turn in range(2):
        more = [(new + i, t + f"\n{LONG} {turn}") for i, (_, t) in enumerate(_lined(rng.integers(0, 300, 2).tolist()))]
        more.append((5, rows.get(5, f"{LONG} again")))  # known already, and its lines come back once deleted
        known = known.insert(_frame(spark, more))
        rows |= dict(more)
        gone = [5, int(rng.choice(sorted(rows))), 77_777]
        known = known.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
        rows = {i: t for i, t in rows.items() if i not in gone}
        new += 10
        assert known.base.inputFiles() == base
        assert known.net.count() <= sum(len(t.split("\n")) for _, t in more) * (turn + 1) + 6 * 2 * (turn + 1)
        fresh = lines.LineIndex.build(_frame(spark, rows.items()))
        for table in ("postings", "refs"):
            assert sorted(map(tuple, getattr(known, table).collect())) == sorted(map(tuple, getattr(fresh, table).collect()))
        assert {r.doc_id: r.text for r in known.dedup(_frame(spark, rows.items())).collect()} == _cut(rows.items(), 5)
    assert sorted(map(tuple, index.refs.collect())) == old
    assert known.delete(_frame(spark, rows.items()).select("doc_id")).net is None


def test_shards_of_the_line_index_grow(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 4)
    index = lines.LineIndex.build(_frame(spark, _lined(range(6), 3)))
    grown = index.insert(_frame(spark, _lined(range(6, 200))))
    assert grown.shards > 2 * index.shards
    assert {r.doc_id: r.text for r in grown.dedup(_frame(spark, _lined(range(6), 3) + _lined(range(6, 200)))).collect()} == _cut(
        _lined(range(6), 3) + _lined(range(6, 200)), 5)


def test_line_dedup_counts(spark):
    out = {r.doc_id: r for r in lines.LineIndex.build(_frame(spark, ROWS)).dedup(_frame(spark, ROWS)).collect()}
    assert (out[6].n_lines, out[6].n_dropped, out[6].text, out[6].shard) == (1, 0, "", 1)
    assert (out[0].n_lines, out[0].n_dropped) == (4, 2)
    assert (out[14].n_dropped, out[13].n_dropped, out[13].text) == (0, 1, "")
    assert lines.LineIndex.build(_frame(spark, [])).dedup(_frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        lines.LineIndex.build(_frame(spark, ROWS)).dedup(_frame(spark, ROWS).withColumn("n_lines", F.lit(1)))


def test_cuckoo_filter():
    keys = np.asarray([int.from_bytes(hashlib.sha256(str(i).encode()).digest()[:8], "little") for i in range(5000)], dtype=np.uint64)
    held = lines.CuckooFilter.of(keys[:3000])
    assert held.holds(keys[:3000]).all() and held.holds(keys[3000:]).mean() < 0.01
    assert all(held.remove(k) for k in keys[:1000])
    again = lines.CuckooFilter.load(held.dump())
    assert again.holds(keys[1000:3000]).all() and again.holds(keys[:1000]).mean() < 0.01


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 16))
    x = np.concatenate([centres[rng.integers(0, 20, 400)] + 0.15 * rng.standard_normal((400, 16)), centres[[0] * 5]])
    labels = [int(v) for v in rng.integers(0, 2, len(x))]
    rows = [(i, [float(v) for v in r], k) for (i, r), k in zip(enumerate(x), labels, strict=True)]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    pairs = [(a, b) for a in range(len(x)) for b in range(a + 1, len(x)) if labels[a] == labels[b] and unit[a] @ unit[b] >= 0.93]
    count, comp = Counter(v for p in pairs for v in p), _union(range(len(x)), pairs)
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, rows[0][1], None), (904, [], 1), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    out = hnsw.near_dedup(df).collect()
    assert len(out) == len(rows) + len(odd)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    assert {i: got[i] for i in range(len(x))} == {i: (count[i], comp[i], comp[i] == i) for i in range(len(x))}
    assert all(got[i] == (0, i, True) for i in range(900, 905)) and got[None] == (0, None, False)
    assert hnsw.near_dedup(df.limit(0)).count() == 0


def _group_of_copies(n=200):
    """Unit vectors that all link with each other."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=16) + 0.01 * rng.normal(size=(n, 16))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _without_inbound(x, nodes):
    graph = hnsw.SmallWorld.build(x.astype(np.float32))
    for links in graph.layers:
        links[np.isin(links, nodes)] = -1
    return graph


def test_unreached_nodes_are_linked():
    x = _group_of_copies()
    entry = hnsw.SmallWorld.build(x.astype(np.float32)).entry
    lost = (entry + 7) % len(x)
    graph = _without_inbound(x, [lost])
    assert graph.unreached().tolist() == [lost]
    # One of 200 links is less than the audit allows to miss, yet each query has it.
    assert {r: len(near) for r, near in hnsw.links_at(graph, x, x, hnsw.THRESHOLD)} == dict.fromkeys(range(len(x)), len(x))


def test_failed_audit_at_the_widest_beam_compares_all(monkeypatch):
    x = _group_of_copies()
    entry = hnsw.SmallWorld.build(x.astype(np.float32)).entry
    graph = _without_inbound(x, [(entry + j) % len(x) for j in range(1, 40)])
    monkeypatch.setattr(hnsw.SmallWorld, "unreached", lambda self: np.zeros(0, dtype=int), raising=False)
    assert {r: len(near) for r, near in hnsw.links_at(graph, x, x, hnsw.THRESHOLD)} == dict.fromkeys(range(len(x)), len(x))


def test_sketches_never_refuse_a_link():
    rng = np.random.default_rng(5)
    for n in (1, 3, 40, 700):
        for share in (0.0, 0.5, 0.9, 1.0):
            x = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            other = rng.integers(0, 1 << 64, 1 + n // 3, dtype=np.uint64)
            y = np.unique(np.concatenate([x[: int(len(x) * share)], other]))
            shared = len(np.intersect1d(x, y))
            most = jaccard.most_shared(jaccard.sketch(x), jaccard.sketch(y), len(x), len(y))
            assert shared <= most <= min(len(x), len(y))
    alone = [np.unique(rng.integers(0, 1 << 64, 500, dtype=np.uint64)) for _ in range(2)]
    assert jaccard.most_shared(*[jaccard.sketch(v) for v in alone], 500, 500) < 300
