"""Scores, classifier, extraction, mix, packing, URL rules and search against brute force, and their odd rows."""

import html
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.compare import connect, differences
from tripmill.llm import ctw, forest, html_text, mixing, packing, quality, registry, urls

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_registered():
    assert sorted(registry.QUERIES, key=lambda x: int(re.findall(r"\d+", x)[0])) == [
        "op1_hnsw_dedup", "op2_ctw_score", "op3_tag_paths", "op4_weak_quality", "op5_line_dedup", "op6_pack",
        "op7_jaccard_join", "op8_pareto_mix", "op9_url_filter", "op10_forest_search",
        "op11_spelling_variants", "op12_bitslice_resample", "op13_toxicity_neighbours"]


# ---- scores ----------------------------------------------------------------------------------

def _brute_ctw(train, texts, depth):
    """log10 of each text by weighting every binary context tree without any shortcut."""
    nodes = Counter()

    def steps(text):
        text = b"\n" * depth + ctw.canonical(text)
        for at in range(depth, len(text)):
            context = text[at - depth:at][::-1]
            for bit in range(8):
                yield context, (bit, text[at] >> (8 - bit)), text[at] >> (7 - bit) & 1

    for text in train:
        for context, q, b in steps(text):
            for d in range(depth + 1):
                nodes[context[:d], q, b] += 1
    log_kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    held = {(c, q) for c, q, _ in nodes}
    pe = {k: log_kt(nodes[(*k, 0)], nodes[(*k, 1)]) for k in held}
    pw, below = {}, Counter()
    for c, q in sorted(held, key=lambda k: -len(k[0])):
        pw[c, q] = pe[c, q] if len(c) == depth else np.logaddexp(pe[c, q], below[c, q]) - math.log(2)
        if c:
            below[c[:-1], q] += pw[c, q]
    out = []
    for text in texts:
        total = 0
        for context, q, b in steps(text):
            p = 0.5
            for d in range(depth, -1, -1):
                k = context[:d], q
                n = nodes[(*k, 0)], nodes[(*k, 1)]
                kt = (n[b] + .5) / (sum(n) + 1)
                share = 1 if d == depth else math.exp(pe[k] - math.log(2) - pw[k]) if k in held else 0.5
                p = share * kt + (1 - share) * p
            total += math.log10(p)
        out.append(total)
    return out


def test_scores_equal_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "then", "Thé", "a", "cat,", "zz9"]) for _ in range(rng.randrange(40))) for _ in range(40)]
    texts += [None, "", "  \n", "x" * 3000, texts[0]]
    rows = [(i, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    raw = [(t or "").encode() for t in texts]
    want = _brute_ctw([t for t, h in zip(raw, held, strict=True) if not h], raw, ctw.DEPTH)
    tokens = [[*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for t in texts]
    counts = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    out = {r.doc_id: r for r in ctw.score_documents(docs, ~ctw.held_out(F.col("doc_id"))).collect()}
    for i, ws in enumerate(tokens):
        assert (out[i].train, out[i].n_tokens, out[i].n_known, out[i].train_tokens) == (not held[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert out[i].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert out[i].score == pytest.approx(want[i], rel=1e-6)
    assert ctw.score_documents(docs.limit(0), F.lit(True)).count() == 0


# ---- classifier ------------------------------------------------------------------------------

def test_quality_against_labels(spark):
    out = {r.doc_id: r.quality_kept for r in quality.op4_weak_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [out[r.doc_id] for r in labels if r.quality == 1]
    bad = [not out[r.doc_id] for r in labels if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) >= 0.9 * len(bad)


def test_quality_of_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(7).alias("code"))
    odd = spark.createDataFrame([(None, None, 1), (-1, "", 1), (-2, " \n", 1), (-3, "A plain line of words. " * 9000, 1)], docs.schema)
    out = {r.doc_id: r for r in quality.classify(docs.unionByName(odd)).collect()}
    assert [(out[i].quality_score, out[i].quality_kept) for i in (None, -1, -2)] == [(0.0, False)] * 3
    assert out[-3].code == 1 and quality.classify(docs.limit(0)).count() == 0


def _plain_facts(text):
    """Words, counts of kinds of bytes, shares of repeated and distinct words, and runs of kinds, one byte at a time."""
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", "\t\x0b\x0c", ".", ",;:", "?", "!", "|",
             "*&#$%^~=+<>{}[]\\_@`", "\"'", "()-/"]
    kind = {ord(c): i for i, chars in enumerate(kinds) for c in chars}
    raw = [14 if b >= 128 else kind.get(b, 15) for b in text.encode()]
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    n = len(words)
    runs = Counter()
    for i in range(len(raw) - quality.RUN + 1):
        mixed = 0
        for k in raw[i:i + quality.RUN]:
            mixed = mixed * 16 + k
        runs[(mixed * 2654435761 % 2**32) >> 20] += 1
    again = sum(a == b for a, b in zip(words, words[1:])) / (n - 1) if n > 1 else 0.0
    return n, Counter(raw), again, len(set(words)) / n if n else 0.0, runs


def _plain_votes(f):
    n, k, again, distinct, _ = f
    bad = lambda x: 0 if x else 2
    letters, ends = k[0] + k[1], k[6] + k[8]
    plain = (sum(k[i] for i in (0, 1, 2, 3, 4, 5, 6, 13, 14))) / max(1, sum(k.values()))
    return [bad(letters >= 20 and k[1] > 0.25 * letters), bad(k[9] > 0.1 * n), bad(k[11] > 0.15 * n), bad(k[10] > 0.08 * n),
            0 if n >= 8 and plain < 0.88 else 1 if plain > 0.94 else 2, bad(n >= 10 and again > 0.08),
            bad(n >= 20 and distinct < 0.3 * min(1.0, 400 / n) ** 0.5),
            0 if n >= 20 and ends < 0.02 * n else 1 if 0.04 * n <= ends <= 0.4 * n else 2]


def _plain_score(f, w):
    n, _, again, distinct, runs = f
    if not n:
        return 0.0
    x = [0.0] * quality.FEATURES
    for i, c in runs.items():
        x[i] = math.sqrt(c / sum(runs.values()))
    for i, value in enumerate((again, distinct, 1 / (1 + n))):
        x[(2654435761 * (i + 1) >> 20) % quality.FEATURES] += value
    return 1 / (1 + math.exp(-sum(a * float(b) for a, b in zip(x, w)) - float(w[-1])))


def test_votes_and_scores_equal_plain_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    voted = {r.doc_id: r.v for r in docs.select("doc_id", quality.votes_of(F.col("text")).alias("v")).collect()}
    facts = {i: _plain_facts(t) for i, t in texts.items()}
    for i, f in facts.items():
        assert voted[i] == (sum(v * 3**k for k, v in enumerate(_plain_votes(f))) if f[0] else -1)
    _, weights = quality.fit_quality(docs)
    out = {r.doc_id: r for r in quality.classify(docs).collect()}
    for i, f in facts.items():
        assert out[i].quality_score == pytest.approx(_plain_score(f, weights), abs=1e-4)
        assert out[i].quality_kept == (out[i].quality_score >= quality.CUT)


def test_em_finds_reliable_labellers():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.8
    votes = np.full((20_000, len(quality.LABELLERS)), quality.ABSTAIN)
    for i, p in enumerate((0.5, 0.4, 0.3, 0.3, 0.6, 0.4, 0.5)):
        votes[~good & (rng.random(20_000) < p), i] = quality.BAD
        votes[good & (rng.random(20_000) < 0.01), i] = quality.BAD
    votes[:, 7] = np.where(rng.random(20_000) < 0.5, quality.GOOD, quality.ABSTAIN)  # knows nothing
    codes, counts = np.unique(votes @ 3 ** np.arange(votes.shape[1]), return_counts=True)
    labels = quality.fit_labels(codes, counts)
    belief = labels.posterior(votes @ 3 ** np.arange(votes.shape[1])) >= 0.5
    assert abs(labels.good - 0.8) < 0.03 and (belief == good).mean() > 0.93
    assert abs(labels.votes[0, 7, quality.GOOD] - labels.votes[1, 7, quality.GOOD]) < 0.05


# ---- extraction ------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header>
<nav><a href=/a>Home</a></nav><div class="cookie-notice"><p>We use cookies, as all do. Accept, please.</p></div><main>
<h1>A title &amp; more</h1><div class="text"><p>First <b>part</b> of a text, with marks. It has   a few
sentences, as an article does.<p>Second one, unclosed &mdash; and it is of some length too, with marks.<ul><li>one item, short</li></ul></div>
<form><p>Your mail, please: <input></p></form><script>var x = "<p>no</p>";</script></main>
<div id="comments"><p>I liked this text very much, and I say so at length, with marks. Really.</p></div>
<aside><p>Other things to read, which are many.</p></aside><footer>&copy; all</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n") == [
        "A title & more", "First part of a text, with marks. It has a few sentences, as an article does.",
        "Second one, unclosed — and it is of some length too, with marks.", "one item, short"]
    for page in ("", "<", "<p", "<script>x", "<!-- open", "<nav><a>only</a></nav>"):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("plain words alone") == "plain words alone"


def _prose(n, word="words"):
    return [f"Sentence {i} of these {word}, with marks, as an article has them. It goes on, at some length." for i in range(n)]


def _paragraphs(lines):
    return "".join(f"<p>{x}</p>" for x in lines)


@pytest.mark.parametrize("share", [5, 8, 15, 19])
def test_selected_text_outside_the_largest_part_stays(share):
    # No <article> or <main>: the first part holds most of the text, and the second is selected too.
    lines = _prose(20)
    page = f"<body><div id=content><h1>Title</h1><div>{_paragraphs(lines[:share])}</div><div>{_paragraphs(lines[share:])}</div></div></body>"
    assert html_text.main_text(page).split("\n") == ["Title", *lines]


@pytest.mark.parametrize("tag", ["section", "div", "pre"])
def test_one_long_part_among_shorter_ones(tag):
    parts = [" ".join(_prose(20)), *_prose(3)]
    page = "<body><div><h2>Title</h2>" + "".join(f"<{tag}>{x}</{tag}>" for x in parts) + "</div></body>"
    assert html_text.main_text(page).split("\n") == ["Title", *parts]


@pytest.mark.parametrize("page, want", [
    ('<article data-title="The hidden city"><h1>T</h1><p>One, two. Three.</p></article>', ["T", "One, two. Three."]),
    ('<body><p>Some first text, with marks.</p><p title="a hidden cost">Second text, with marks.</p></body>', ["Some first text, with marks.", "Second text, with marks."]),
    ('<body><div class="page sidebar-right"><h1>T</h1><p>One two, three. Four.</p><p>More, really. Yes.</p></div><div>stray</div></body>',
     ["T", "One two, three. Four.", "More, really. Yes."]),
    ('<body><div>stray</div><div class="post social-history"><h1>T</h1><p>One two, three. Four.</p><p>More, really. Yes.</p></div></body>',
     ["T", "One two, three. Four.", "More, really. Yes."]),
    ("<article><h1>A</h1><p>One two, three. Four five six.</p><article><p>A nested one, long enough to be text. Yes.</p></article></article>",
     ["A", "One two, three. Four five six.", "A nested one, long enough to be text. Yes."]),
    ("<body><div>Home About Contact</div><article><p>One two, three. Four five six.</p></article></body>", ["One two, three. Four five six."]),
    ("<form id=f><nav><a href=x>Home</a></nav><h1>T</h1><div><p>One two, three. Four.</p></div><footer>(c) all</footer></form>", ["T", "One two, three. Four."]),
    ("<p>a < b and c<d, as said.</p><p style='display:none'>No, never. Not at all.</p>", ["a < b and c<d, as said."]),
])
def test_attributes_and_names_lose_no_article(page, want):
    assert html_text.main_text(page).split("\n") == want


def test_the_ratios_choose():
    lines = _prose(8)
    page = f"<body><div>Home About Contact</div><div id=x><h1>Title</h1>{_paragraphs(lines)}</div><div>Terms Privacy Imprint</div></body>"
    assert html_text.main_text(page).split("\n") == ["Title", *lines]
    assert html_text.main_text(page, by_ratio=False) != html_text.main_text(page)


@pytest.mark.parametrize("page", [
    "<a " * 300_000, "<div>" * 50_000 + "x" + "</div>" * 50_000, "<b>x" * 50_000, "<b>" * 50_000 + "<div>x</div>" * 50_000,
    "<div><p>" * 50_000 + "</i>" * 50_000, '<a b="' * 200_000, "<a x='<b y=\"" * 100_000, "<ul><li>" * 30_000 + "<li>y" * 30_000,
    "a < b " * 200_000, "<a" * 300_000, "<dt>" + "<span>" * 30_000 + "<td>x" * 30_000, "<!-" * 300_000, "<script>" + "</script " * 100_000])
def test_time_grows_with_the_page(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 8


def _built_page(rng):
    """A page of random make, and its article's lines. Parts around it are named, or links, or lists of words without marks."""
    def sentence(n=None):
        return " ".join(rng.choice(["river", "stone", "mill", "old", "Été", "walks", "by"]) for _ in range(n or rng.randint(6, 14))) + rng.choice([".", ", of course.", "!"])

    def paragraph():
        return " ".join(sentence() for _ in range(rng.randint(2, 5)))

    title, body = sentence(5), []
    marked = [f"<h1>{title}</h1>"]
    want = [title]
    for _ in range(rng.randint(4, 9)):
        text = paragraph()
        body.append(text)
        kind = rng.randrange(4)
        marked.append(f"<p>{text}</p>" if kind < 2 else f"<p>{text}" if kind == 2 else f"<p>{text.replace('old', '<b>old</b>')}</p>")
        want.append(text)
    open_tag, close_tag = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ('<div class="story">', "</div>"), ("<div>", "</div>"), ("<section id=s1>", "</section>")])
    links = "".join(f'<li><a href="/{i}">{sentence(2)}</a></li>' for i in range(6))
    before = [f"<nav><ul>{links}</ul></nav>", f"<ul>{links}</ul>", f"<div class='menu'>{links}</div>", f'<div class="ad-box">{sentence()}</div>',
              "<div>Home News Contact</div>", f"<header><p>{sentence()}</p></header>", f"<form><p>{sentence()}</p><input></form>"]
    after = [f'<div id="comments"><p>{paragraph()}</p></div>', f"<aside>{sentence()}</aside>", f"<footer><p>{sentence()}</p></footer>", "<script>x = '<p>no</p>';</script>",
             f'<p hidden>{paragraph()}</p>', f"<div class=related>{links}</div>", f"<div style='display: none'>{paragraph()}</div>"]
    page = "".join(rng.sample(before, rng.randint(0, 4))) + open_tag + "".join(marked) + close_tag + "".join(rng.sample(after, rng.randint(0, 4)))
    return f"<!doctype html><html><head><title>{title}</title></head><body>{page}</body></html>", want


def test_built_pages_give_their_articles():
    rng = random.Random(8)
    wrong = []
    for _ in range(400):
        page, want = _built_page(rng)
        if html_text.main_text(page).split("\n") != want:
            wrong.append((page, want, html_text.main_text(page)))
    assert not wrong, (len(wrong), wrong[0])


def test_extraction_of_all_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in html_text.op3_tag_paths(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", inner)]
        assert r.text == "\n".join(b for b in want if b) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "<p>" + "word, " * 200_000, "k")], "page_id long, html string, url string")
    out = {r.page_id: r for r in html_text.extract_text(odd).collect()}
    assert (out[1].text, out[1].n_chars, out[1].url, out[2].text) == ("", 0, "k", "") and out[3].n_chars == 1_199_999


# ---- packing ---------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_and_fills_well(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 2049, rng.integers(1, 4000)) if seed % 2 else np.minimum(2048, rng.geometric(1 / 300, 3000))
    counts = Counter(int(x) for x in lengths)
    used, plan = Counter(), packing.pack_counts(counts)
    for parts, times in plan:
        assert sum(parts) <= 2048
        for p in parts:
            used[p] += times
    assert used == counts
    least = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))
    assert sum(t for _, t in plan) <= least * 1.025 + 1


def test_words_of_letters_do_not_need_the_whole_tokenizer(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    words, whole = packing.WordIds(path), Tokenizer.from_file(path)
    asked = []
    monkeypatch.setattr(words, "_encode", lambda word, encode=words._encode: asked.append(word) or encode(word))
    plain = "École, été. Straße; ÀÉÎ! größe? Zürich: 2024, x1. word. End"
    odd = "a.b., ?! e\u0301. \u0130stanbul. \u03a3\u03c3\u03a3, don't. $$$. ×. ÷, ª. <|endoftext|>. 3.14, 中文. naïve\u0301,"
    for text in (plain, odd, "", "  ", plain + " " + odd, plain.upper(), "\n".join(odd.split())):
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.ids(text.encode()), dtype="<u4").tolist() == want
    asked.clear()
    fresh = "Étéé, écolé. Straßé; éàî! größé? Zürichü: é"
    words.ids(fresh.encode())
    # The end marks are known by now.
    assert asked == []


def test_pack_is_an_exact_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit("x").alias("length"))
    odd = spark.createDataFrame([(None, None, "x"), (-1, "", "x"), (-2, "Word's, <|endoftext|> x" * 3000, "x"), (-3, "don't, we'll. Été!", "x"),
        (-4, "<|ENDOFTEXT|>", "x"), (-5, "a<|EndOfText|>b. <|endoftext|> x<|startoftext|>Y.", "x"), (-6, "<|ENDOFTEXT|>" * 400 + "<|endoftext|>" * 3 + " Ab", "x")] * 2, docs.schema)
    docs = docs.unionByName(odd)
    out = [r.asDict() for r in packing.pack(docs).collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for r in docs.collect():
        ids = np.asarray([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.update((r.doc_id, k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 2048
    assert packing.pack(docs.limit(0)).count() == 0


# ---- mix -------------------------------------------------------------------------------------

def _targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        out = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if out[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return out | {s: 3 * sizes[s] for s in capped}
        capped |= over


def test_mix_meets_targets(spark):
    out = mixing.op8_pareto_mix(spark, "/root/testdata/sf0.01").collect()
    again = mixing.op8_pareto_mix(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in out:
        s = docs[r.doc_id].source
        assert r.size == len(WORD.findall(docs[r.doc_id].text)) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        sizes[s] += r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    want = _targets(sizes)
    for r in out:
        s = docs[r.doc_id].source
        assert (r.source_size, r.target) == (sizes[s], pytest.approx(want[s]))
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)


def test_mix_of_odd_rows(spark):
    rows = [(1, "a b c", None, 1), (2, None, "x", 1), (3, "", "x", 1), (4, "w " * 500, "y", 1), (None, "one two", "y", 1)] + [(9, "same words", "z", 1)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight int")
    out = mixing.pareto_mix(docs).collect()
    assert len(out) == len(rows) and all(0 <= r.copies <= 3 for r in out)
    assert {r.source_size for r in out if r.source == "x"} == {0} and all(r.target == 0 for r in out if r.source == "x")
    assert mixing.pareto_mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.pareto_mix(docs.withColumn("target", F.lit(1)))


def test_pareto_order_follows_affinity(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("w w").alias("text"), (F.col("id") % 2).cast("string").alias("source"))
    odd = F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0)
    got = mixing.pareto_mix(docs, weights=(1, 3), affinity=odd).where("source = '0'").groupBy((F.col("doc_id") % 4 < 2).alias("often")).agg(F.sum("copies").alias("n"))
    n = {r.often: r.n for r in got.collect()}
    assert sum(n.values()) == 1000 and 2.6 < n[True] / n[False] < 3.4


def _brute_mix(rows, most=3):
    """Copies of each (key, source, size, u, affinity): rates by halving, then the Pareto order to its target."""
    sizes = Counter()
    for _, s, n, _, _ in rows:
        sizes[s] += n
    want, copies = _targets(sizes), {}
    for s, target in want.items():
        own = [r for r in rows if r[1] == s]
        words = lambda rate: sum(n * min(rate * a, most) for _, _, n, _, a in own)
        low, high = 0.0, most / min(r[4] for r in own)
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if words(middle) < target else (low, middle)
        expected = {r[0]: min(high * r[4], most) for r in own}
        sure = {k: int(math.floor(m + 1e-12)) for k, m in expected.items()}
        open_words = target - sum(sure[r[0]] * r[2] for r in own)
        order = []
        for k, _, n, u, _ in own:
            p = expected[k] - sure[k]
            if p > 1e-9:
                order.append(((u / (1 - u)) / (p / (1 - p)), k, n))
        for _, k, n in sorted(order):
            if 2 * open_words < n:
                break
            sure[k], open_words = sure[k] + 1, open_words - n
        copies |= sure
    return copies


@pytest.mark.parametrize("skewed", [False, True])
def test_mix_equals_a_plain_pareto_sample(spark, skewed):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"), F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 13 + 1).cast("int")), " ").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
        (F.when(F.col("id") % 10 == 0, 60.0).otherwise(1 + F.col("id") % 5) if skewed else F.lit(1.0)).cast("double").alias("a"))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(17), "doc_id"), 11).cast("double") + 0.5) / float(1 << 53)
    rows = [(r.doc_id, r.source, r.n, r.u, r.a) for r in docs.select("*", u.alias("u"), F.size(F.split("text", " ")).alias("n")).collect()]
    got = {r.doc_id: r for r in mixing.pareto_mix(docs, affinity=F.col("a") if skewed else None).collect()}
    want = _brute_mix(rows)
    assert {i: r.copies for i, r in got.items()} == want
    taken = Counter()
    for i, s, n, _, _ in rows:
        taken[s] += n * want[i]
    assert all(abs(taken[r.source] - r.target) <= 7 for r in got.values())


def test_mix_leaves_texts_in_place(spark):
    """The plan has a row per source and goes to the documents, not they to it."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    plan = mixing.pareto_mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


# ---- URLs, search and the pipeline -----------------------------------------------------------

def test_url_filter_equals_sql(spark):
    assert differences(urls.op9_url_filter(spark, SF), connect(SF), urls.OP9_SQL) is None


def test_rules_are_met_by_short_digests(spark, monkeypatch):
    out = urls.op9_url_filter(spark, SF)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "_url_short" in line and "Join" in line]
    assert joins and all("_url_full" not in line and "_url_own" not in line for line in joins)
    # Many rules by a shuffle, and digests of which many begin alike.
    monkeypatch.setattr(urls, "FEW_RULES", 0)
    monkeypatch.setattr(urls, "PREFIX_DIGITS", 0)
    assert differences(urls.op9_url_filter(spark, SF), connect(SF), urls.OP9_SQL) is None


def test_url_rules(spark):
    rules = spark.createDataFrame(
        [("block", "b.org", "/x"), ("allow", "a.b.org", "/"), ("block", "a.b.org", "/"), ("allow", "c.org", "/ab"), ("block", "x.c.org", "/"), ("block", None, "/")],
        urls.RULE_SCHEMA)
    cases = {
        "http://B.org/xyz?q": ("b.org", "/xyz", "b.org/x", "block"), "http://ab.org/x": ("ab.org", "/x", None, "allow"),
        "s://q.a.b.org/x#f": ("q.a.b.org", "/x", "a.b.org/", "block"), "http://x.c.org/abc": ("x.c.org", "/abc", "x.c.org/", "block"),
        "http://b.org?x/": ("b.org", "", None, "allow"), "no url": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
        "http://" + "a." * 5000 + "b.org/x": ("a." * 5000 + "b.org", "/x", "a.b.org/", "block")}
    pages = spark.createDataFrame([(u, "k") for u in cases] * 2, "url string, n string")
    out = urls.judge_urls(pages, rules).collect()
    assert len(out) == 2 * len(cases) and all((r.host, r.path, r.rule, r.verdict) == cases[r.url] for r in out)
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_forest_search(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 12)) * rng.uniform(0.5, 2, (1500, 1))
    x[7] = x[8]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(2000, None), (2020, [0.0] * 12), (2040, [math.inf] * 12), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = forest.nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 1500, 20):
        scores = x @ x[q]
        best = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:20]
        hits += len({i for i, _ in got[q]} & set(best))
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True) and all(s == pytest.approx(scores[i]) for i, s in got[q])
    assert set(got) == set(range(0, 1500, 20)) and hits >= 0.9 * 20 * 75
    few = forest.nearest_neighbours(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert len(few) == 2 and forest.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0


def test_trees_prune_a_clustered_set():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((200, 24))
    x = centres[rng.integers(0, 200, 20_000)] + 0.35 * rng.standard_normal((20_000, 24))
    ids = np.arange(20_000)
    longest = (x * x).sum(axis=1).max()
    trees = forest.Forest.build(np.column_stack([x, np.sqrt(longest - (x * x).sum(axis=1))]))
    asked = np.arange(0, 20_000, 100)
    out, share = forest.search(trees, x, ids, x[asked], asked, 20)
    hits = 0
    for (got, _), q in zip(out, asked, strict=True):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(got) & set(np.argsort(-scores)[:20]))
    assert hits >= 0.9 * 20 * len(asked) and share < 1 / 3


def test_the_queue_is_only_asked_where_margins_tie(monkeypatch):
    import heapq

    def plain(trees, margin, most):
        """One queue over all trees, a leaf at a time."""
        queue, rows = sorted((-np.inf, r) for r in trees.roots), set()
        while queue and len(rows) < most:
            worst, node = heapq.heappop(queue)
            while node >= 0:
                m = margin[node]
                left, right = trees.children[node]
                near, far = (right, left) if m > 0 else (left, right)
                heapq.heappush(queue, (max(worst, abs(m)), far))
                node = near
            rows |= set(trees.leaves[-node - 1].tolist())
        return sorted(rows)

    rng = np.random.default_rng(12)
    even = rng.standard_normal((3000, 16))
    for x in (even, rng.integers(0, 3, (700, 4)).astype(float), np.repeat(even[:3], 300, axis=0), even[:20]):
        trees = forest.Forest.build(x)
        asked = x[::max(1, len(x) // 9)]
        margins = (asked.astype(np.float32) @ trees.normals.T - trees.offsets).tolist()
        for most in (1, 40, len(x) // 2, len(x)):
            got = [rows.tolist() for rows in trees.candidates(asked, most)]
            assert got == [plain(trees, m, most) for m in margins]
    pops = []
    monkeypatch.setattr(forest.heapq, "heappop", lambda queue, pop=heapq.heappop: pops.append(1) or pop(queue))
    trees = forest.Forest.build(even)
    assert all(len(rows) >= 1500 for rows in trees.candidates(even[:50], 1500)) and len(pops) < 50 * 60


def test_forest_search_of_odd_rows(spark):
    rows = [(20, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (40, [0.0, 1.0], 1), (40, [0.0, 2.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.5, 0.5], 1),
            (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [], 1), (7, [1.0, 2.0, 3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int").withColumns(
        {c: F.lit(9) for c in ("id", "dim", "salt", "ask", "rank", "score")})
    got = forest.nearest_neighbours(df, F.col("vec_id") % 20 == 0, 3).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    # Equal rows ask once; ties go to the smaller vec_id; the rows of vec_id 40 ask each.
    assert sorted(by[20]) == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 0.5)]
    assert sorted(r[0] for r in by[40]) == [1, 1, 2, 2, 3, 3] and {r[1] for r in by[40]} <= {1, 2, 3, 20}
    hundred = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(100)], "vec_id long, embedding array<double>")
    tied = forest.nearest_neighbours(hundred, F.col("vec_id") == 60).collect()
    assert sorted((r["rank"], r.vec_id) for r in tied) == [(i + 1, i) for i in range(20)]


def test_each_stage_equals_plain_python_on_its_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (-5, "", "en", "s", 0), (-6, "A line of words that is long enough to count as one.\n" * 4000, "en", "s", 0),
           (-7, "one text, of a few words only.", "en", "s", 0), (-7, "another text under that number, as it is.", "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(5))
    stages = dict(corpus_pipeline.STAGES)

    def go(name, rows):
        stages[name](spark, rows, SF).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    def texts(rows):
        return Counter((r.doc_id, r.text) for r in rows.collect())

    # Quality: the plain score of each text, with the fitted weights.
    _, weights = quality.fit_quality(docs.select("doc_id", "text"))
    good = go("quality", docs)
    scores = {t: _plain_score(_plain_facts(t or ""), weights) for t in {r.text for r in docs.collect()}}
    sure = {t: s >= quality.CUT for t, s in scores.items() if abs(s - quality.CUT) > 1e-3}
    want = Counter({k: n for k, n in texts(docs).items() if sure.get(k[1], False)})
    assert not want - texts(good) and all(sure.get(k[1], True) for k in texts(good))
    # Lines: keys of 40 code points in five documents stay in the largest only.
    lined = go("line_dedup", good)
    holders = {}
    blanks = " \t\n\x0b\x0c\r"
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(blanks))
    for i, t in texts(good):
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    cut = lambda i, t: "\n".join(x for x in (t or "").split("\n") if len(holders.get(key(x), ())) < 5 or i == max(holders[key(x)]))
    want = Counter()
    for (i, t), n in texts(good).items():
        want[i, cut(i, t)] += n
    assert texts(lined) == want
    # Near duplicates: components over five-word shingles; one document each.
    single = go("near_duplicates", lined)
    sets = {}
    for i, t in texts(lined):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(i, []).append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()})
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                u, v = root(a), root(b)
                parent[max(u, v)] = min(u, v)
    assert texts(single) == Counter({(i, t): 1 for i, t in texts(lined) if root(i) == i})
    # Mix: a plain Pareto sample.
    mixed = go("mix", single)
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(17), "doc_id"), 11).cast("double") + 0.5) / float(1 << 53)
    rows = [((r.doc_id, r.text), r.source, len(WORD.findall(r.text or "")), r.u, 1.0) for r in single.select("*", u.alias("u")).collect()]
    want = _brute_mix(rows)
    assert texts(mixed) == Counter({k: n for k, n in want.items() if n})
    # Pack: every id of every row, once.
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    packed = go("pack", mixed)
    want = Counter()
    for r in mixed.collect():
        ids = np.asarray([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.update((r.doc_id, k, zlib.crc32(ids[at:at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048)))
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed.collect()) == want


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = spark.createDataFrame([(None, None, None, None, None), (-5, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(first)
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "pack":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
            assert 0 < docs.select("doc_id").distinct().count() <= before.select("doc_id").distinct().count()
            empty = stage(spark, before.limit(0), SF)
            assert empty.count() == 0 and tuple(empty.columns) == corpus_pipeline.COLUMNS
    assert docs.agg(F.max("length")).first()[0] <= 2048
