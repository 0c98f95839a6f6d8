"""Operator 4: language identification by a bidirectional gated recurrent network over bytes.

The text's UTF-8 bytes are labelled in windows of STEPS bytes, each of which the network reads with the CONTEXT bytes before and after
it. Two gated recurrent layers of UNITS cells run over them, one in each direction; a linear layer over both gives every position of the window
a distribution over the languages, and a document's probability of a language is the mean over all its positions. So every position is labelled
once, having seen at least CONTEXT bytes on either side, where the text has them. The network is trained in numpy by backpropagation through time with Adam.

Bounds: learns from at most LEARN_ROWS documents, the same number of each language but LEAST_ROWS at least (the lowest by a seeded
hash of doc_id, outside the held-out fold). Training takes UPDATES steps of BATCH windows, drawn from all places of those texts. Every language that
stands there is predicted, and every position of every text is labelled.

Defined results: a null text, or one without any letter, is `und` with score 0; without anything to learn from all are `und`; a null
doc_id counts as fold 0 (learned from); a null lang is not learned from; repeated rows score alike; an empty table gives an empty result;
extra columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_rows, crc32_mod, prepare, saved

LEARN_ROWS = 3000
#: Documents learned from of each language, if there are so many languages that LEARN_ROWS would give fewer.
LEAST_ROWS = 30
STEPS, CONTEXT, UNITS, BATCH, UPDATES, RATE = 64, 32, 8, 256, 220, 0.02
FOLDS, HELD_OUT, UNKNOWN = 3, 1, "und"
#: Windows that run through the network at once, for up to RUN_LANGUAGES languages; fewer for more.
RUN, RUN_LANGUAGES = 1024, 64
#: Leading bits of a hash by which a language's documents are counted.
BITS = 12


@dataclass
class Network:
    """Two directions, each: input weights by byte (3H, 256) with bias, recurrent weights (3H, H); output (C, 2H) and bias (C, 1)."""

    languages: list[str]
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias]


def blank(languages: list[str], seed: int = 7) -> Network:
    r, h, c = np.random.Generator(np.random.PCG64(seed)), UNITS, len(languages)
    f = lambda *shape: (r.standard_normal(shape) * 0.3).astype(np.float32)
    return Network(languages, [f(3 * h, 256) for _ in "fb"], [f(3 * h, h) for _ in "fb"], f(c, 2 * h), np.zeros((c, 1), np.float32))


def hidden(net: Network, x: np.ndarray, direction: int, keep: list | None = None) -> np.ndarray:
    """States (T, H, B) of one direction over bytes x (T, B), aligned with positions; `keep` gets what training needs."""
    t_all, b = x.shape
    h, w, u = UNITS, net.inputs[direction], net.recurrent[direction]
    out = np.empty((t_all, h, b), np.float32)
    state = np.zeros((h, b), np.float32)
    given, a = np.empty((3 * h, b), np.float32), np.empty((3 * h, b), np.float32)
    for t in range(t_all) if direction == 0 else range(t_all - 1, -1, -1):
        np.take(w, x[t], axis=1, out=given, mode="clip")
        np.matmul(u, state, out=a)
        # the logistic function as half a tanh of half the argument plus a half
        gates = given[: 2 * h] + a[: 2 * h]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[:h], gates[h:]
        n = r * a[2 * h :]
        n += given[2 * h :]
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((t, state, gates, n, a[2 * h :].copy()))
        state = out[t]
        np.subtract(keep[-1][1] if keep is not None else _before(out, t, direction, h, b), n, out=state)
        state *= z
        state += n
    return out


def _before(out: np.ndarray, t: int, direction: int, h: int, b: int) -> np.ndarray | np.float32:
    k = t - 1 if direction == 0 else t + 1
    return out[k] if 0 <= k < len(out) else np.float32(0)


def positions(net: Network, x: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities (T, C, B) of every position of windows x (CONTEXT + T + CONTEXT, B), and the states (T, 2H, B) they come from."""
    end = len(x) - CONTEXT
    before = hidden(net, x[:end], 0, keep[0] if keep else None)[CONTEXT:]
    after = hidden(net, x[CONTEXT:], 1, keep[1] if keep else None)[: end - CONTEXT]
    states = np.concatenate([before, after], axis=1)
    logits = np.matmul(net.output, states) + net.bias
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits, states


def gradients(net: Network, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over the positions in mask (T, B), and its gradient, by backpropagation through time, contexts included."""
    kept: tuple[list, list] = ([], [])
    p, states = positions(net, x, kept)
    t_all, b = mask.shape
    h, total = UNITS, max(1.0, float(mask.sum()))
    loss = -float((np.log(np.maximum(p[:, y, np.arange(b)], 1e-9)) * mask).sum()) / total
    d = p.copy()
    d[:, y, np.arange(b)] -= 1
    d *= mask[:, None, :] / total
    g_out = np.einsum("tcb,thb->ch", d, states, optimize=True)
    g_bias = d.sum(axis=(0, 2))[:, None]
    d_states = np.matmul(net.output.T, d)
    g_in, g_rec = [], []
    for k in (0, 1):
        u, gw, gu = net.recurrent[k], np.zeros_like(net.inputs[k]), np.zeros_like(net.recurrent[k])
        carry, own = np.zeros((h, b), np.float32), x[: len(x) - CONTEXT] if k == 0 else x[CONTEXT:]
        for t, before, gates, n, an in reversed(kept[k]):
            at = t - CONTEXT if k == 0 else t
            dh = d_states[at, k * h : (k + 1) * h] + carry if 0 <= at < t_all else carry
            z, r = gates[:h], gates[h:]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * an * r * (1 - r)
            given = np.concatenate([dz, dr, dn])
            through = np.concatenate([dz, dr, dn * r])
            carry = dh * z + u.T @ through
            gu += through @ before.T
            for row in range(3 * h):
                gw[row] += np.bincount(own[t], given[row], 256)
        g_in.append(gw)
        g_rec.append(gu)
    return loss, [*g_in, *g_rec, g_out, g_bias]


def windows(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as (n, CONTEXT + STEPS + CONTEXT) windows, each with its neighbours' edges and zeros beyond the text, and how many of its positions lie in the text."""
    n = -(-len(data) // STEPS)
    out = np.zeros(CONTEXT + n * STEPS + CONTEXT, np.uint8)
    out[CONTEXT : CONTEXT + len(data)] = np.frombuffer(data, np.uint8)
    lengths = np.full(n, STEPS, np.int64)
    if n:
        lengths[-1] = len(data) - STEPS * (n - 1)
    width = STEPS + 2 * CONTEXT
    return np.lib.stride_tricks.sliding_window_view(out, width)[::STEPS][:n], lengths


def window_at(data: bytes, at: int) -> tuple[np.ndarray, int]:
    """One window that starts anywhere."""
    low, high = max(0, at - CONTEXT), min(len(data), at + STEPS + CONTEXT)
    out = np.zeros(STEPS + 2 * CONTEXT, np.uint8)
    out[low - at + CONTEXT : high - at + CONTEXT] = np.frombuffer(data, np.uint8, high - low, low)
    return out, min(STEPS, len(data) - at)


def train(rows: list[tuple[str, str]], updates: int = UPDATES, seed: int = 7) -> Network | None:
    """Fit on (text, language) rows; languages are drawn evenly, then texts, then places."""
    r = np.random.Generator(np.random.PCG64(seed))
    by: dict[str, list[bytes]] = {}
    for text, lang in rows:
        if text and lang is not None and any(map(str.isalpha, text)):
            by.setdefault(lang, []).append(text.encode("utf-8", "replace"))
    languages = sorted(by)
    if not languages:
        return None
    net = blank(languages, seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, updates + 1):
        y = r.integers(0, len(languages), BATCH)
        texts = [by[languages[k]][r.integers(0, len(by[languages[k]]))] for k in y]
        drawn = [window_at(t, int(r.integers(0, max(1, len(t) - STEPS // 2)))) for t in texts]
        x = np.stack([w for w, _ in drawn]).T
        mask = (np.arange(STEPS)[:, None] < np.array([n for _, n in drawn])[None, :]).astype(np.float32)
        _, grads = gradients(net, np.ascontiguousarray(x), y, mask)
        rate = RATE * min(1.0, 2 * (1 - step / (updates + 1)))
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        for p, g, m, v in zip(net.parameters(), grads, first, second, strict=True):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def position_labels(net: Network, text: str | None) -> list[tuple[int, int, str]]:
    """The labels of all positions as runs (start, end, language) over the bytes of a text's UTF-8; a few windows run at once, however long it is."""
    if not text:
        return []
    cut, lengths = windows(text.encode("utf-8", "replace"))
    best = []
    for at in range(0, len(cut), RUN):
        p, _ = positions(net, np.ascontiguousarray(cut[at : at + RUN].T))
        best += [k[:n] for k, n in zip(p.argmax(axis=1).T, lengths[at : at + RUN], strict=True)]
    labels = np.concatenate(best)
    edges = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1], [True]]))
    return [(int(a), int(b), net.languages[labels[a]]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def probabilities(net: Network, texts: list[str | None]) -> np.ndarray:
    """Mean distribution over all positions of each text (n, C); zeros for empty texts. Windows of all texts run together."""
    out = np.zeros((len(texts), len(net.languages)))
    cut, owner, lengths = [], [], []

    def run() -> None:
        x, own, n = np.concatenate(cut), np.concatenate(owner), np.concatenate(lengths)
        most = max(1, RUN * RUN_LANGUAGES // max(RUN_LANGUAGES, len(net.languages)))
        for at in range(0, len(x), most):
            part = slice(at, at + most)
            p, _ = positions(net, np.ascontiguousarray(x[part].T))
            if (n[part] == STEPS).all():
                sums = p.sum(axis=0)
            else:
                sums = np.einsum("tcb,tb->cb", p, (np.arange(STEPS)[:, None] < n[part][None, :]).astype(np.float32))
            for c in range(len(net.languages)):
                out[:, c] += np.bincount(own[part], sums[c], len(texts))

    held = 0
    for i, text in enumerate(texts):
        if text:
            w, n = windows(text.encode("utf-8", "replace"))
            cut.append(w), owner.append(np.full(len(w), i)), lengths.append(n)
            held += len(w)
            if held >= 16 * RUN:
                run()
                cut, owner, lengths, held = [], [], [], 0
    if held:
        run()
    total = out.sum(axis=1, keepdims=True)
    return np.divide(out, total, out=np.zeros_like(out), where=total > 0)


def chosen(docs: DataFrame, bound: int = LEARN_ROWS, least: int = LEAST_ROWS) -> DataFrame:
    """text and lang of the documents to learn from: of each language, the lowest by hash, up to an equal share of the bound."""
    # rows without a letter teach nothing and take no place
    rows = docs.select("doc_id", "text", "lang").where((crc32_mod(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", F.xxhash64(F.lit("lang"), "doc_id").alias("k"), F.xxhash64("text").alias("h"), "text")
    rows = rows.withColumn("bucket", F.shiftright("k", 64 - BITS))
    # how far to read comes from counts by bucket, so that neither texts nor all ids of a language ever meet
    counts = saved(rows.groupBy("lang", "bucket").count(), "learned-counts")
    each = max(least, bound // max(1, counts.select("lang").distinct().count()))
    before = F.coalesce(F.sum("count").over(W.partitionBy("lang").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = counts.withColumn("before", before).where(F.col("before") < each).groupBy("lang").agg(F.max("bucket").alias("last"))
    # one row a language, as the network has
    got = rows.join(F.broadcast(last), "lang").where(F.col("bucket") <= F.col("last"))
    return got.withColumn("at", F.row_number().over(W.partitionBy("lang").orderBy("k", "h"))).where(F.col("at") <= each).orderBy("k", "h", "lang").select("text", "lang")


def learned(docs: DataFrame, bound: int = LEARN_ROWS) -> Network | None:
    """Fit on a bounded number of documents; only those texts come to the driver."""
    got = chosen(docs, bound).toPandas()
    return train(list(zip(got["text"], got["lang"], strict=True)))


def with_language(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """The operator: adds lang_pred and lang_score (columns of these names are replaced)."""
    prepare(docs.sparkSession)
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("lang_pred", "lang_score")]
    if net is None:
        return as_rows(docs).select(*own, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("lang_score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            p = probabilities(m, list(texts))
            best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            letters = [bool(t) and any(map(str.isalpha, t)) for t in texts]
            yield pd.DataFrame({"lang": [m.languages[k] if ok else UNKNOWN for k, ok in zip(best, letters, strict=True)], "score": [float(min(1.0, p[i, k])) if letters[i] else 0.0 for i, k in enumerate(best)]})

    found = as_rows(docs).select("row", predict(F.col(f"row.{text}" if "." in text else f"row.`{text}`")).alias("found"))
    return found.select(*own, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("lang_score"))


def with_position_labels(docs: DataFrame, net: Network | None, text: str = "text", to: str = "lang_runs") -> DataFrame:
    """The operator's other output: adds the labels of all positions, an array of runs (start, end, lang) over the text's bytes."""
    prepare(docs.sparkSession)
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != to]
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("array<struct<start:int,end:int,lang:string>>")
    def label(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([[dict(zip(("start", "end", "lang"), x, strict=True)) for x in position_labels(m, t)] if m else [] for t in texts])

    return as_rows(docs).select(*own, label(F.col(f"row.`{text}`")).alias(to))


def op4_byte_bigru_language(docs: DataFrame) -> DataFrame:
    out = with_language(docs.select("doc_id", "text"), learned(docs))
    return out.select("doc_id", (crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


#: Least probability of the predicted language at which the pipeline keeps a document.
LEAST_SCORE = 0.3


def identified_documents(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The pipeline's stage: documents without a recognised language go."""
    found = with_language(as_rows(docs), learned(docs), text="row.text")
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= least)).select("row.*")
