"""Statistics of one text, computed over its UTF-8 bytes and its words; whole texts, a few passes, memory linear in the text."""

from __future__ import annotations

import math

import numpy as np

from .common import spans, window_hashes

SYMBOLS = b"#*$%&|<>"
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WINDOW = 5


def byte_counts(data: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(data, np.uint8), minlength=256)


def code_points(counts: np.ndarray) -> int:
    """Code points of valid UTF-8: all bytes but continuation bytes."""
    return int(counts.sum() - counts[0x80:0xC0].sum())


def repeated_words(hashes: np.ndarray, size: int = WINDOW) -> int:
    """Words that lie in a run of `size` words found twice or more in the text, the first occurrence included."""
    n = len(hashes)
    if n <= size:
        return 0
    runs = window_hashes(hashes, size)
    ordered = np.sort(runs)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(runs, twice))
    edges = np.zeros(n + 1, np.int64)
    edges[at] += 1
    edges[at + size] -= 1
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_SYMBOL, _SPACE = list(SYMBOLS), list(SPACES)
_PUNCT = np.array([33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 for c in range(256)])

FEATURES = (
    "log_bytes", "log_words", "mean_word", "sd_word", "longest_word", "upper", "digits", "punctuation", "symbols", "exclamations", "spaces", "lines_a_word", "distinct_words",
    "top_word", "repeated", "duplicate_lines", "non_ascii", "byte_entropy", "sentence_ends", "capitals", "common_pairs", "upper_of_letters",
)


def features(text: str | None) -> np.ndarray:
    """The statistics a quality classifier sees; all zero for a null, empty or blank text."""
    out = np.zeros(len(FEATURES), np.float32)
    data = text.encode("utf-8", "replace") if text else b""
    hashes, starts, lengths = spans(data)
    if not len(hashes):
        return out
    counts = byte_counts(data)
    n, w = len(data), len(hashes)
    ordered = np.sort(hashes)
    ends = np.flatnonzero(np.concatenate([ordered[1:] != ordered[:-1], [True]]))
    held = np.diff(ends, prepend=-1)
    share = counts[counts > 0] / n
    upper = int(counts[_UPPER].sum())
    letters = upper + int(counts[_LOWER].sum())
    first = np.frombuffer(data, np.uint8)[starts]
    mean = float(lengths.mean())
    out[:] = (
        math.log1p(n), math.log1p(w), mean, math.sqrt(max(0.0, float(np.dot(lengths, lengths)) / w - mean * mean)), int(lengths.max()), upper / n, counts[_DIGIT].sum() / n, counts[_PUNCT].sum() / n, counts[_SYMBOL].sum() / n, counts[33] / n,
        counts[_SPACE].sum() / n, counts[10] / w, len(held) / w, held.max() / w, repeated_words(hashes) / w, repeated_lines(data) / (counts[10] + 1), counts[128:].sum() / n, -float(np.dot(share, np.log2(share))),
        (counts[46] + counts[33] + counts[63]) / w, np.count_nonzero((first >= 65) & (first <= 90)) / w, float(held[held > 1].sum()) / w, upper / max(1, letters),
    )
    return out
