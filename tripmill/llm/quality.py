"""Quality classifier from weak labels: labeller accuracies by expectation-maximisation, then a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import folded_words, release, require, stash, texts_in_pieces

BAD, GOOD, ABSTAIN = 0, 1, 2
#: Documents that the scorer is fitted on, at most, half of them from either side of the weak labels.
SAMPLE = 4000
#: Hashed features, the length of the runs of character kinds they count, and the steps of the fit.
FEATURES, RUN, STEPS = 4096, 5, 150
#: Documents scored below this are rejected.
CUT = 0.25

# Kinds of bytes: letters, digits, blanks, marks that end or part sentences, other marks each by a few kinds.
_KIND = np.full(256, 15, dtype=np.uint32)
for _k, _chars in enumerate((
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t\x0b\x0c", b".", b",;:", b"?",
        b"!", b"|", b"*&#$%^~=+<>{}[]\\_@`", b"\"'", b"()-/")):
    _KIND[list(_chars)] = _k
_KIND[128:] = 14
_LOWER, _UPPER, _DOT, _ASK, _CRY, _BAR, _SIGN = 0, 1, 6, 8, 9, 10, 11


@dataclass
class Facts:
    """What the labellers and the scorer see of a text."""

    words: int
    kinds: np.ndarray
    repeated: float
    distinct: float
    runs: np.ndarray


def _facts(column: pa.Array, runs: bool) -> Iterator[Facts]:
    """Facts of each whole text, in order. ``runs``: hashes of runs of kinds too, else none."""
    none = np.zeros(0, dtype=np.int64)
    for _, _, raw, offsets in texts_in_pieces(column):
        hashes, _, first = folded_words(raw, offsets)
        kinds = _KIND[np.frombuffer(raw, dtype=np.uint8)]
        hashed = none
        if runs and len(kinds) >= RUN:
            mixed = np.zeros(len(kinds) - RUN + 1, dtype=np.uint32)
            for j in range(RUN):
                mixed = mixed * np.uint32(16) + kinds[j:j + len(mixed)]
            hashed = ((mixed * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
        for row in range(len(offsets) - 1):
            a, b = int(first[row]), int(first[row + 1])
            x, y = int(offsets[row]), int(offsets[row + 1])
            own = hashes[a:b]
            n = b - a
            again = float((own[1:] == own[:-1]).mean()) if n > 1 else 0.0
            yield Facts(n, np.bincount(kinds[x:y], minlength=16), again, len(np.unique(own)) / n if n else 0.0,
                        hashed[x:max(x, y - RUN + 1)])


# ---- labellers -------------------------------------------------------------------------------
# Each looks at one trait and abstains unless it is plain. They overlap on purpose: what one kind of
# junk shows, two or more of them see.

def _fires(trait: bool) -> int:
    return BAD if trait else ABSTAIN


def _capitals(f: Facts) -> int:
    letters = f.kinds[_LOWER] + f.kinds[_UPPER]
    return _fires(letters >= 20 and f.kinds[_UPPER] > 0.25 * letters)


def _cries(f: Facts) -> int:
    return _fires(f.kinds[_CRY] > 0.1 * f.words)


def _signs(f: Facts) -> int:
    return _fires(f.kinds[_SIGN] > 0.15 * f.words)


def _bars(f: Facts) -> int:
    return _fires(f.kinds[_BAR] > 0.08 * f.words)


def _letters(f: Facts) -> int:
    # Letters, digits, blanks and the marks of addresses and numbers.
    plain = f.kinds[:6].sum() + f.kinds[_DOT] + f.kinds[13:15].sum()
    share = plain / max(1, f.kinds.sum())
    return BAD if f.words >= 8 and share < 0.88 else GOOD if share > 0.94 else ABSTAIN


def _repeats(f: Facts) -> int:
    return _fires(f.words >= 10 and f.repeated > 0.08)


def _variety(f: Facts) -> int:
    return _fires(f.words >= 20 and f.distinct < 0.3 * min(1.0, 400 / f.words) ** 0.5)


def _sentences(f: Facts) -> int:
    ends = f.kinds[_DOT] + f.kinds[_ASK]
    return BAD if f.words >= 20 and ends < 0.02 * f.words else GOOD if 0.04 * f.words <= ends <= 0.4 * f.words else ABSTAIN


LABELLERS = (_capitals, _cries, _signs, _bars, _letters, _repeats, _variety, _sentences)


def votes_of(text: Column) -> Column:
    """The labellers' votes as digits of base 3 (0 bad, 1 good, 2 abstains); -1 for a text without words."""

    @F.arrow_udf("int")
    def code(column: pa.Array) -> pa.Array:
        out = []
        for f in _facts(column, runs=False):
            votes = [label(f) for label in LABELLERS] if f.words else []
            out.append(sum(v * 3**i for i, v in enumerate(votes)) if f.words else -1)
        release()
        return pa.array(out, pa.int32())

    return code(text)


@dataclass
class Labels:
    """What EM has learned: the share of good documents, and per class and labeller how it votes."""

    good: float
    votes: np.ndarray

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """Probability of good."""
        given = _digits_of(codes)
        log = np.log(np.asarray([1 - self.good, self.good]))[:, None] + sum(
            np.log(self.votes[:, i, given[:, i]]) for i in range(given.shape[1]))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def _digits_of(codes: np.ndarray) -> np.ndarray:
    return (np.asarray(codes)[:, None] // 3 ** np.arange(len(LABELLERS))) % 3


def fit_labels(codes: np.ndarray, counts: np.ndarray, steps: int = 60) -> Labels:
    """EM over how many documents show each pattern of votes, from a start by a majority in which bad votes weigh more."""
    given = _digits_of(codes)
    bad, good = (given == BAD).sum(axis=1), (given == GOOD).sum(axis=1)
    belief = np.where(bad > 0, (good + 0.1) / (good + 4 * bad + 0.2), 0.95)
    labels = Labels(0.5, np.zeros((2, len(LABELLERS), 3)))
    for _ in range(steps):
        weight = np.stack([(1 - belief) * counts, belief * counts])
        labels.good = float(np.clip((weight[1].sum() + 1) / (weight.sum() + 2), 1e-6, 1 - 1e-6))
        for v in range(3):
            labels.votes[:, :, v] = weight @ (given == v)
        labels.votes += 0.5
        labels.votes /= labels.votes.sum(axis=2, keepdims=True)
        belief = labels.posterior(codes)
    return labels


# ---- the scorer ------------------------------------------------------------------------------

def features(f: Facts) -> np.ndarray:
    """Hashed features of a text: roots of shares of runs of kinds, and of what repeats."""
    x = np.bincount(f.runs, minlength=FEATURES).astype(np.float32)
    x = np.sqrt(x / max(1.0, float(x.sum())))
    for i, value in enumerate((f.repeated, f.distinct, 1 / (1 + f.words))):
        x[(2654435761 * (i + 1) >> 20) % FEATURES] += value
    return x


def fit_scorer(x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights and, last, a bias of a logistic model for soft labels, both sides of equal weight. The last column of ``x`` is all ones."""
    w = np.zeros(x.shape[1], dtype=np.float32)
    share = y.mean() if len(y) else 0.5
    y = y.astype(np.float32)
    side = (y / max(2 * share, 1e-6) + (1 - y) / max(2 * (1 - share), 1e-6)).astype(np.float32)
    speed = np.zeros_like(w)
    for _ in range(steps if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = ((p - y) * side) @ x / np.float32(len(y)) + np.float32(1e-5) * w
        speed = np.float32(0.9) * speed - np.float32(5) * gradient
        w += speed
    return w


def score_of(text: Column, weights: np.ndarray) -> Column:
    """The scorer's probability of good for each whole text; 0 without words."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        out = [float(features(f) @ weights[:-1] + weights[-1]) if f.words else -np.inf for f in _facts(column, runs=True)]
        raw = np.asarray(out, dtype=float)
        release()
        return pa.array(np.where(raw == -np.inf, 0.0, 1 / (1 + np.exp(-np.clip(raw, -700, 700)))))

    return score(text)


def fit_quality(docs: DataFrame, sample: int = SAMPLE) -> tuple[Labels, np.ndarray]:
    """(labels, scorer weights) from ``docs`` (doc_id, text).

    Votes of all documents are counted per pattern, at most 3 ** 8 numbers, and EM runs on these. The
    scorer is fitted on at most ``sample`` documents, those of smallest hash on either side.
    """
    key = F.xxhash64("doc_id", F.octet_length("text")).alias("h")
    voted = stash(docs.select(key, votes_of(docs["text"]).alias("code")).where("code >= 0"), "votes")
    counted = voted.groupBy("code").count().collect()
    codes, counts = (np.asarray([r[i] for r in counted], dtype=np.int64) for i in (0, 1))
    labels = fit_labels(codes, counts) if len(codes) else Labels(0.5, np.full((2, len(LABELLERS), 3), 1 / 3))
    good = labels.posterior(codes) if len(codes) else np.zeros(0)
    belief = dict(zip(codes.tolist(), good.tolist(), strict=True))

    @F.arrow_udf("binary")
    def packed(column: pa.Array) -> pa.Array:
        return pa.array([features(f).tobytes() for f in _facts(column, runs=True)], pa.binary())

    # One matrix, filled as rows come in; the last column is for the bias.
    x, y = np.ones((sample, FEATURES + 1), dtype=np.float32), np.zeros(sample)
    n = 0
    sides = [side.tolist() for side in (codes[good >= 0.5], codes[good < 0.5]) if len(side)]
    for side in sides:
        # At most sample / 2 rows, so that they may be broadcast. Copies of a row count once.
        chosen = voted.where(F.col("code").isin(side)).dropDuplicates(["h"]).orderBy("h", "code").limit(sample // 2)
        texts = docs.select(key, "text").join(F.broadcast(chosen), "h").dropDuplicates(["h"])
        for r in texts.select("code", packed(F.col("text")).alias("x")).toLocalIterator():
            x[n, :-1], y[n] = np.frombuffer(r["x"], dtype=np.float32), belief[r["code"]]
            n += 1
    return labels, fit_scorer(x[:n], y[:n])


def classify(docs: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """``docs`` with quality_score (double) and quality_kept (boolean).

    Overlapping heuristic labellers vote on every whole text or abstain; EM estimates how
    reliable each is from how often all patterns of votes occur, without any given label; the
    posterior labels train a linear scorer over hashed features, which scores every text. A
    document scored below ``cut`` is not kept.

    A null or empty text, or one of blanks alone, has score 0 and is not kept. Repeated rows and
    rows with a null doc_id are scored like any other. An empty table gives no rows. Extra columns
    stay; those named like a result are refused.
    """
    if clash := [c for c in docs.columns if c.lower() in {"quality_score", "quality_kept"}]:
        raise ValueError(f"columns clash with the result: {clash}")
    _, weights = fit_quality(require(docs, ["doc_id", "text"]), sample)
    scored = docs.withColumn("quality_score", score_of(docs["text"], weights))
    return scored.withColumn("quality_kept", F.col("quality_score") >= cut)


def op4_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, quality_score, quality_kept."""
    docs = require(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id", "text"])
    return classify(docs).select("doc_id", "quality_score", "quality_kept")
