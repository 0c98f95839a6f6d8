"""Operator 8: quality classifier, histogram gradient-boosted trees over document statistics.

Training bins each statistic once by its quantiles; a level of a tree is grown from histograms of gradients and Hessians over
those bins, and the split with the best gain wins. A forest is flattened into parallel arrays (feature, threshold, left, right,
value), so scoring a batch walks all trees of all rows at once with a few numpy gathers.

Bounds: learns from at most LEARN_ROWS labelled rows outside the held-out fold, the lowest by a seeded hash of doc_id. All rows
are scored, over whole texts.

Defined results: null, empty and blank texts have all statistics 0 and are scored like any others; without labelled rows, or with
rows of one label only, the score is that label's share (0.5 without rows); a null doc_id counts as fold 0 (held out);
labels that are null are not learned from; repeated rows score alike; an empty table gives an empty result; extra columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_rows, crc32_mod, prepare
from .textstats import FEATURES, features

LEARN_ROWS = 12_000
BINS, DEPTH, ROUNDS, RATE, LEAST_WEIGHT, SHRINK = 64, 4, 80, 0.15, 4.0, 1.0
FOLDS, HELD_OUT, GOOD = 5, 0, 0.3


@dataclass
class Forest:
    """Trees as arrays; a leaf points to itself, so that a walk of fixed length ends there."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        total = np.full(len(rows), self.base)
        if len(self.roots) and len(rows):
            at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
            line = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                at = np.where(rows[line, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total = total + self.value[at].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -40, 40)))


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH) -> Forest:
    """Boost on the logistic loss."""
    share = float(labels.mean()) if len(labels) else 0.5
    base = float(np.log(np.clip(share, 1e-4, 1 - 1e-4) / np.clip(1 - share, 1e-4, 1 - 1e-4)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    if len(labels) and 0 < share < 1:
        edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(rows.shape[1])]
        binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        margin = np.full(len(rows), base)
        for _ in range(rounds):
            p = 1.0 / (1.0 + np.exp(-margin))
            slope, bend = p - labels, np.maximum(p * (1 - p), 1e-6)
            first = len(feature)
            roots.append(first)

            def leaf(g: float, h: float) -> int:
                k = len(feature)
                feature.append(0), threshold.append(0.0), left.append(k), right.append(k), value.append(-RATE * g / (h + SHRINK))
                return k

            leaf(float(slope.sum()), float(bend.sum()))
            node = np.full(len(rows), first)
            open_ = [first]
            for _level in range(depth):
                place = {k: i for i, k in enumerate(open_)}
                slot = np.full(len(feature), -1)
                slot[open_] = np.arange(len(open_))
                own = slot[node]
                live = own >= 0
                width = BINS + 1
                best: dict[int, tuple] = {}
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    key = own[live] * width + binned[live, f]
                    g = np.bincount(key, slope[live], len(open_) * width).reshape(len(open_), width).cumsum(axis=1)
                    h = np.bincount(key, bend[live], len(open_) * width).reshape(len(open_), width).cumsum(axis=1)
                    n = np.bincount(key, minlength=len(open_) * width).reshape(len(open_), width).cumsum(axis=1)
                    G, H, N = g[:, -1:], h[:, -1:], n[:, -1:]
                    gain = g**2 / (h + SHRINK) + (G - g) ** 2 / (H - h + SHRINK) - G**2 / (H + SHRINK)
                    gain[(n < 20) | (N - n < 20) | (h < LEAST_WEIGHT / 10) | (H - h < LEAST_WEIGHT / 10)] = -1.0
                    gain = gain[:, : len(e)]
                    cut = gain.argmax(axis=1)
                    for k, i in place.items():
                        x = float(gain[i, cut[i]])
                        if x > 1e-6 and (k not in best or x > best[k][0]):
                            c = int(cut[i])
                            best[k] = (x, f, c, float(g[i, c]), float(h[i, c]), float(G[i, 0]), float(H[i, 0]))
                open_ = []
                for k, (_, f, c, g, h, G, H) in best.items():
                    a, b = leaf(g, h), leaf(G - g, H - h)
                    feature[k], threshold[k], left[k], right[k] = f, float(edges[f][c]), a, b
                    here = node == k
                    low = here & (binned[:, f] <= c)
                    node[low], node[here & ~low] = a, b
                    open_ += [a, b]
                if not open_:
                    break
            margin = margin + np.asarray(value)[node]
    return Forest(np.array(feature, np.int64), np.array(threshold, np.float32), np.array(left, np.int64), np.array(right, np.int64), np.array(value), np.array(roots, np.int64), base, depth)


def learned(docs: DataFrame, labels: DataFrame, bound: int = LEARN_ROWS) -> Forest:
    """Fit on at most `bound` labelled rows; what comes to the driver is one short vector for each."""
    prepare(docs.sparkSession)

    @F.pandas_udf("array<float>")
    def text_features(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    keep = crc32_mod(F.col("doc_id"), FOLDS) != HELD_OUT
    known = labels.where(F.col("quality").isNotNull() & keep).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # repeated rows could bring more vectors than ids, so the bound holds for rows as well
    got = docs.select("doc_id", "text").where(keep).join(F.broadcast(chosen), "doc_id").select("doc_id", text_features("text").alias("x"), "quality")
    got = got.orderBy(F.xxhash64("doc_id"), F.xxhash64("x")).limit(bound).toPandas()
    if not len(got):
        return fit(np.zeros((0, len(FEATURES)), np.float32), np.zeros(0))
    x = np.stack(got["x"].to_list())
    order = np.lexsort((*x.T[::-1], got["doc_id"].to_numpy()))  # the order in which rows arrive never matters
    return fit(x[order].astype(np.float32), got["quality"].to_numpy(np.float64)[order])


def with_quality(docs: DataFrame, forest: Forest, text: str = "text", to: str = "quality_score") -> DataFrame:
    """The operator: adds a score between 0 and 1."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = np.stack([features(t) for t in texts]) if len(texts) else np.zeros((0, len(FEATURES)), np.float32)
            yield pd.Series(shared.value.scores(rows))

    return docs.withColumn(to, score(F.col(text)))


def op8_boosted_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = with_quality(docs.select("doc_id", "text"), learned(docs, labels), to="score")
    return out.select("doc_id", (crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, least: float = GOOD) -> DataFrame:
    """The pipeline's stage: documents the classifier rejects go."""
    return with_quality(as_rows(docs), learned(docs, labels), text="row.text", to="score").where(F.col("score") >= least).select("row.*")
