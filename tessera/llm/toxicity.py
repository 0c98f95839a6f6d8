"""Operator 2: toxic passages by maximum-scoring segment search.

A model is a weight per token: the log-odds of the token in toxic against clean labelled texts, both smoothed by a Dirichlet
prior proportional to the token's share of all labelled texts, kept where the same log-odds over texts that hold the token has a
significant z-score (a token that one text repeats is one observation), and shifted so that an
average token of clean text scores below zero. A linear-time scan finds every maximal scoring segment of a text. Segment
scores follow an extreme-value law, so a segment of score S among n tokens has an expectation K * n * exp(-lambda * S) by
chance; lambda solves sum p * exp(lambda * s) = 1 over clean text and K is calibrated on the same learned rows. A document's
score is that of all its significant segments together against chance or, without one, of its best: 0.5 where chance would give EXPECTED
such segments, less with all that chance would give more often, 0 without any token in favour.

Bounds: the model learns from at most LEARN_ROWS labelled rows, the lowest by a seeded hash of doc_id (a documented bound on
fitting). Of near copies with one label the first is counted: texts that share the least or
the greatest hash of their 5-word runs and NEAR of the least hashes in SLOTS parts of the range. All rows are scored, over whole texts.

Defined results: null and empty texts have no segment and score 0; without any labelled toxic or clean row the model is empty
and all texts score 0; a null doc_id counts as fold 0 (held out); repeated rows score alike; labels that are null are not
learned from; extra columns never matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_rows, crc32_mod, prepare, spans, window_hashes

#: Labelled rows that may be learned from, and the prior's weight as a share of the learned tokens.
LEARN_ROWS, PRIOR = 12_000, 1.0
#: A token is kept from such a z-score that FALSE_TOKENS of all tokens tested would reach it by chance, from these log-odds (of the smoothed
#: classes) and from this number of toxic texts that hold it.
FALSE_TOKENS, LEAST_ODDS, LEAST_DOCS = 0.3, 1.0, 3
FOLDS, HELD_OUT = 5, 0
#: A segment is reported, and a document called toxic, below this expectation by chance.
EXPECTED = 0.5

#: Parts of the range of hashes that give one least hash each, and the share of them that near copies have in common.
SLOTS, NEAR = 64, 0.5

_PUNCTUATION = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits as UTF-8 (ASCII punctuation parts them)."""
    return text.lower().encode("utf-8", "replace").translate(_PUNCTUATION).split() if text else []


@dataclass
class Model:
    weights: dict[bytes, float]
    other: float
    rate: float
    scale: float


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, by the linear-time scan.

    Only tokens above zero can start or end a segment; between them the running sum is all that is needed, so the scan visits
    those tokens alone. Candidates are kept with the running sums at their left (l) and right (r) ends; each is merged into
    the nearest earlier one whose l is lower while its r is lower too.
    """
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    total = np.cumsum(scores)
    found: list[tuple[int, int, float, float, int]] = []  # start, end, l, r, the nearest earlier candidate with a lower l
    for at in places.tolist():
        r = float(total[at])
        l = r - float(scores[at])
        start = end = at
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= l:
                j = found[j][4]
            if j < 0 or found[j][3] >= r:
                found.append((start, end, l, r, j))
                break
            start, l = found[j][0], found[j][2]
            del found[j:]
    return [(s, e + 1, r - l) for s, e, l, r, _ in found]


def decay_rate(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * value)) = 1, by bisection; needs a negative mean and some positive value."""
    low, high = 1e-6, 1.0
    f = lambda x: float(np.dot(shares, np.exp(np.minimum(x * values, 500)))) - 1.0
    while f(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return (low + high) / 2


def sketches(words: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Of the hashes of a text's 5-word runs: the least and the greatest, and the least in each of SLOTS parts of the range (0: none)."""
    least = np.zeros(SLOTS, np.uint32)
    if not words:
        return [], least
    hashes = np.sort(window_hashes(spans(b" ".join(words))[0], 5))
    slots, first = np.unique(hashes >> np.uint64(64 - SLOTS.bit_length() + 1), return_index=True)
    least[slots.astype(np.int64)] = (hashes[first] & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return [int(hashes[0]), ~int(hashes[-1])], least


class Seen:
    """Texts of one label that have been counted."""

    def __init__(self):
        self.by: dict[int, list[int]] = {}
        self.least = np.zeros((64, SLOTS), np.uint32)
        self.n = 0

    def add(self, words: list[bytes]) -> bool:
        """Whether the text is new, that is no near copy of one before."""
        ends, least = sketches(words)
        before = self.least[sorted({i for e in ends for i in self.by.get(e, ())})]
        filled = (before > 0) | (least > 0)
        if len(before) and (((before == least) & filled).sum(axis=1) >= NEAR * filled.sum(axis=1)).any():
            return False
        if self.n == len(self.least):
            self.least = np.concatenate([self.least, np.zeros_like(self.least)])
        self.least[self.n] = least
        for e in ends:
            self.by.setdefault(e, []).append(self.n)
        self.n += 1
        return True


def log_odds(a: float, b: float, n1: float, n0: float) -> tuple[float, float]:
    """Log-odds of a among n1 against b among n0, both smoothed by the prior, and its z-score."""
    both = PRIOR * (a + b) / (n1 + n0)
    x1, x0 = a + both * n1, b + both * n0
    odds = math.log(x1 / max((1 + PRIOR) * n1 - x1, 0.5)) - math.log(x0 / max((1 + PRIOR) * n0 - x0, 0.5))
    return odds, odds / math.sqrt(1 / x1 + 1 / x0)


def train(rows: list[tuple[str, int]]) -> Model:
    """Fit weights and calibrate chance on (text, label) rows.

    The prior gives each class PRIOR times its size in tokens, dealt by a token's share of both classes together.
    """
    counts = ({}, {})
    holders = ({}, {})
    held_texts = [0, 0]
    texts = [(tokens(t), int(y)) for t, y in rows]
    seen = (Seen(), Seen())
    for words, y in texts:
        if not seen[y].add(words):
            continue  # a copy or near copy of a text that has been counted would count its rare tokens again
        own = counts[y]
        for w in words:
            own[w] = own.get(w, 0) + 1
        held_texts[y] += 1
        own = holders[y]
        for w in set(words):
            own[w] = own.get(w, 0) + 1
    n1, n0 = sum(counts[1].values()), sum(counts[0].values())
    if not n1 or not n0:
        return Model({}, -1.0, 1.0, 1.0)
    kept = []
    tested = [(w, docs) for w, docs in holders[1].items() if docs >= LEAST_DOCS]
    least_z = NormalDist().inv_cdf(1 - min(0.01, FALSE_TOKENS / max(1, len(tested))))
    for w, docs in tested:
        odds, _ = log_odds(counts[1][w], counts[0].get(w, 0), n1, n0)
        _, z = log_odds(docs, holders[0].get(w, 0), *held_texts[::-1])
        if z >= least_z and odds >= LEAST_ODDS:
            kept.append((z, w, odds))
    kept.sort(key=lambda x: (-x[0], x[1]))
    weights = {w: odds for _, w, odds in kept}
    clean = sum(counts[0].get(w, 0) * s for w, s in weights.items()) / n0
    other = -max(0.1, 4 * clean)  # an ordinary token lowers a segment's score, so that chance segments end
    values = np.array([*weights.values(), other])
    held = np.array([counts[0].get(w, 0) + 0.5 for w in weights] or [0.0])
    shares = np.append(held, max(n0 - held.sum(), 1.0)) / (held.sum() + max(n0 - held.sum(), 1.0))
    rate = decay_rate(values, shares) if weights else 1.0
    model = Model(weights, other, rate, 1.0)
    # K by the clean rows: the best segment of a clean text exceeds S with probability 1 - exp(-K n exp(-rate S))
    pairs = [(len(w), max((s for *_, s in maximal_segments(scored(w, model))), default=0.0)) for w, y in texts if not y and w]
    mean = float(np.mean([n * math.exp(-rate * s) for n, s in pairs])) if pairs else 1.0
    # E[n exp(-rate S)] is 1 / K under the law
    model.scale = min(max(1.0 / max(mean, 1e-9), 1e-6), 1.0)
    return model


def scored(words: list[bytes], model: Model) -> np.ndarray:
    get, other = model.weights.get, model.other
    return np.array([get(w, other) for w in words], dtype=np.float64)


def expected(score: float, n: int, model: Model) -> float:
    """How many segments of at least this score n tokens of clean text would hold."""
    return model.scale * n * math.exp(-min(model.rate * score, 700.0))


def all_segments(text: str | None, model: Model) -> list[tuple[int, int, float, float]]:
    """All maximal segments of a text: start and end in tokens, score, expectation by chance."""
    words = tokens(text)
    if not words or model.weights.keys().isdisjoint(words):
        return []
    return [(s, e, x, expected(x, len(words), model)) for s, e, x in maximal_segments(scored(words, model))]


def segments(text: str | None, model: Model, most: float = EXPECTED) -> list[tuple[int, int, float, float]]:
    """Significant segments of a text."""
    return [f for f in all_segments(text, model) if f[3] <= most]


def document_score(found: list[tuple[int, int, float, float]]) -> float:
    """0.5 at an expectation of EXPECTED, towards 1 as the significant segments' joint expectation falls, towards 0 as the best one's
    grows. A text without any segment has no evidence at all: 0."""
    if not found:
        return 0.0
    evidence = [math.log(EXPECTED / max(f[3], 1e-300)) for f in found]
    total = sum(x for x in evidence if x > 0) or max(evidence)
    return 1.0 / (1.0 + math.exp(-min(total, 50.0)))


def learned(docs: DataFrame, labels: DataFrame, bound: int = LEARN_ROWS) -> Model:
    """Fit on at most `bound` labelled rows outside the held-out fold, the lowest by hash."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", "text").where(crc32_mod(F.col("doc_id"), FOLDS) != HELD_OUT)
    chosen = known.where(crc32_mod(F.col("doc_id"), FOLDS) != HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # repeated rows could bring more texts than ids, so the bound holds for rows as well
    got = rows.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(bound).select("text", "toxic").toPandas()
    return train([(t or "", y) for t, y in zip(got["text"], got["toxic"], strict=True)])


def with_segments(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The operator: adds toxic_segments, an array of (start, end, score, expected) in tokens, and toxic_score (columns of these names are replaced)."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("segments array<struct<start:int,end:int,score:double,expected:double>>, score double")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            found = [all_segments(t, m) for t in texts]
            shown = [[dict(zip(("start", "end", "score", "expected"), f, strict=True)) for f in x if f[3] <= EXPECTED] for x in found]
            yield pd.DataFrame({"segments": shown, "score": [document_score(x) for x in found]})

    found = as_rows(docs).select("row", search(F.col(f"row.`{text}`")).alias("found"))
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("toxic_segments", "toxic_score")]
    return found.select(*own, F.col("found.segments").alias("toxic_segments"), F.col("found.score").alias("toxic_score"))


def op2_toxic_segments(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = learned(docs, labels)
    out = with_segments(docs.select("doc_id", "text"), model)
    held = crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT
    return out.select("doc_id", held.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"), F.size("toxic_segments").alias("n_segments"))
