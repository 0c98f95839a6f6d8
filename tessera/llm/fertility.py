"""Operator 6: quality rules by tokeniser fertility.

Base rules look at words, symbols and repetition. Fertility rules ask how well two public vocabularies fit a text, each by code points per
token, the share of tokens that are bare bytes, and the entropy of the token distribution (against the most that so many tokens
could have). Texts are judged against the band of their cell, the dominant script and
language, over all lengths: a centre +- BAND robust deviations, never narrower than a floor; deviations and floors are in units
that widen for short texts. The centre is the median; evenness falls with length, so its centre is a line in
log2 of the tokens, through the medians with the median slope. A cell with fewer than LEAST_TEXTS distinct texts takes the band of its script, a script with fewer that of all texts; these mix languages, so they are wider. The bands are statistics of all
distinct texts that pass the base rules.

Words are tokenised alone (the vocabularies never merge across white space), and each worker remembers words, up to a bound.

Defined results: a null text has no word, fails the base rules and is not kept, as do empty and blank texts; a null language
is a language of its own; a table of fewer than LEAST_TEXTS distinct texts is judged by the band of all; copies of
a text count once in a cell's band, and are judged alike; texts of any length are measured whole; extra
columns are ignored; a table without `lang` uses scripts alone.
"""

from __future__ import annotations

import base64
import math
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, saved, spans
from .textstats import SPACES, SYMBOLS, byte_counts, code_points, repeated_lines, repeated_words

#: Vocabulary files: a sentencepiece model, which gives byte fallback and entropy as well, and byte-pair ranks.
VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_50k.tiktoken")
#: Fewest words, and the largest share of repeated words in hundredths.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Half-width of a band in robust standard deviations, and the least half-widths: a + b / sqrt(tokens), as short texts vary more.
BAND = 4.0
FLOORS = {f"{m}{k}": v for k in ("", "_2") for m, v in (("chars_per_token", (0.3, 3.0)), ("byte_share", (0.02, 0.3)), ("evenness", (0.05, 0.6)))}
#: Measures that fall with length, so that a band's centre is a line.
TILTED = ("evenness", "evenness_2")
#: A band of several languages is as wide as this quantile of their distances, times a margin, at least: its median knows only the commonest.
MIXED_QUANTILE, MIXED_MARGIN = 0.9, 1.5
#: Distinct texts that make a band.
LEAST_TEXTS = 30
#: Words remembered by a worker for each vocabulary, and the longest that is.
REMEMBERED, LONGEST = 500_000, 64
#: First code points of the scripts told apart (fixed values of Unicode's blocks), and their names.
SCRIPTS = ((0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "other"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0780, "other"), (0x0900, "Indic"), (0x0E00, "Thai"), (0x0E80, "other"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "none"), (0x2C00, "other"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"), (0xD7B0, "none"), (0xF900, "Han"), (0xFB00, "other"), (0x1F000, "none"), (0x20000, "Han"))
_FIRST = np.array([a for a, _ in SCRIPTS], np.uint32)
_NAMES = sorted({n for _, n in SCRIPTS})
_NAME_OF = np.array([_NAMES.index(n) for _, n in SCRIPTS])


def script(text: str, counts: np.ndarray) -> str:
    """The script with most letters; ASCII letters are Latin."""
    ascii_letters = int(counts[65:91].sum() + counts[97:123].sum())
    far = int(counts[0xC0:].sum())
    if far <= ascii_letters:
        return "Latin" if ascii_letters else "none"
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    points = points[points >= 0x80]
    found = np.bincount(_NAME_OF[np.searchsorted(_FIRST, points, side="right") - 1], minlength=len(_NAMES))
    found[_NAMES.index("none")] = 0
    found[_NAMES.index("Latin")] += ascii_letters
    return _NAMES[int(found.argmax())] if found.any() else "none"


class Vocabulary:
    """Token ids of words, remembered as bytes of 32-bit integers. What remembers is bounded, and lives as long as the worker."""

    size: int
    #: By id: whether the token is a bare byte, or bytes that are no text by themselves.
    is_byte: np.ndarray

    def __init__(self):
        self.known: dict[bytes, bytes] = {}

    def encoded(self, words: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def ids(self, words: list[bytes]) -> np.ndarray:
        try:
            return np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4")
        except KeyError:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            known = self.known
            new = list(set(words).difference(known))
            ids = [array("I", i).tobytes() for i in self.encoded([w.decode("utf-8", "replace") for w in new])]
            known.update(zip(new, ids, strict=True))
            out = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4")
            for w in new:
                if len(w) > LONGEST:
                    del known[w]
            return out

    def measured(self, words: list[bytes], chars: int) -> tuple[float, float, float, int]:
        """Code points per token, share of byte tokens, entropy against the most that so many tokens could have, number of tokens."""
        ids = self.ids(words)
        tokens = len(ids)
        if not tokens:
            return float(chars), 0.0, 0.0, 0
        ordered = np.sort(ids)
        held = np.diff(np.flatnonzero(np.concatenate([ordered[1:] != ordered[:-1], [True]])), prepend=-1) / tokens
        most = math.log2(max(2, min(tokens, self.size)))
        return chars / tokens, float(np.count_nonzero(self.is_byte[ids])) / tokens, -float(np.dot(held, np.log2(held))) / most, tokens


class Pieces(Vocabulary):
    """A sentencepiece model, whose byte tokens stand in for what it doesn't know."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])

    def encoded(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)


def _whole(token: bytes) -> bool:
    try:
        token.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


class Ranks(Vocabulary):
    """Byte-pair ranks, each word after a blank; a byte token is one that isn't valid UTF-8 by itself."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.encode = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.size = max(ranks.values()) + 1
        self.is_byte = np.zeros(self.size, bool)
        self.is_byte[[rank for token, rank in ranks.items() if not _whole(token)]] = True

    def encoded(self, words: list[str]) -> list[list[int]]:
        return [self.encode(" " + w) for w in words]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One of each a worker process: a sentencepiece model by its ending, byte-pair ranks otherwise."""
    if path not in _LOADED:
        _LOADED[path] = (Pieces if path.endswith(".model") else Ranks)(path)
    return _LOADED[path]


#: What is measured for each vocabulary; the second one's have the suffix _2.
MEASURES = ("chars_per_token", "byte_share", "evenness")


def measure(text: str | None, first: Vocabulary, second: Vocabulary) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, script, the measures of both vocabularies, n_tokens of the first."""
    data = text.encode("utf-8", "replace") if text else b""
    hashes, starts, lengths = spans(data)
    n = len(hashes)
    if not n:
        return 0, 0, 0, 0, 0, "none", *(None,) * 6, 0
    counts = byte_counts(data)
    chars = code_points(counts) - sum(int(counts[c]) for c in SPACES)
    words = data.split()
    *own, tokens = first.measured(words, chars)
    *other, _ = second.measured(words, chars)
    return n, chars, sum(int(counts[c]) for c in SYMBOLS), repeated_lines(data), repeated_words(hashes), script(text, counts), *own, *other, tokens


_COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, script string, " + "".join(f"{m}{k} double, " for k in ("", "_2") for m in MEASURES) + "n_tokens long"


def with_measures(docs: DataFrame, vocabularies=VOCABULARIES, folder: str | None = None) -> DataFrame:
    """doc_id, lang, a hash of the text and the measures of every text."""
    prepare(docs.sparkSession)

    @F.pandas_udf(_COLUMNS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        first, second = (vocabulary(os.path.join(folder, v) if folder else public_tokenizers.path(v)) for v in vocabularies)
        names = [c.split()[0] for c in _COLUMNS.split(", ")]
        for texts in batches:
            yield pd.DataFrame([measure(t, first, second) for t in texts], columns=names)

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", lang.alias("lang"), F.xxhash64("text").alias("text_hash"), run(F.col("text")).alias("m")).select("doc_id", "lang", "text_hash", "m.*")


def _off(measure: str) -> Column:
    """Distance from a band's centre, in units of the least half-width."""
    floor, spread = FLOORS[measure]
    centre = F.col(f"mid_{measure}") + (F.col(f"tilt_{measure}") * (F.col("log_tokens") - F.col("mid_log_tokens")) if measure in TILTED else 0)
    return F.abs(F.col(measure) - centre) / (F.lit(floor) + F.lit(spread) / F.sqrt(F.greatest(F.col("n_tokens"), F.lit(1))))


def bands(passing: DataFrame, band: float = BAND) -> DataFrame:
    """The band of each cell, each script and all texts, from three passes of mergeable sketches, so a huge group costs no more than its partials."""
    median = lambda c: F.percentile_approx(c, 0.5, 10_000)
    # copies of a text count once: they have equal measures, and are folded before they move
    distinct = saved(passing.select("cell", "script", "text_hash", "n_tokens", "log_tokens", *FLOORS).dropDuplicates(["cell", "text_hash"]), "distinct-texts")
    rows = distinct.select(F.explode(F.array("cell", "script", F.lit(""))).alias("band"), "n_tokens", "log_tokens", *FLOORS)
    # bands are few (scripts x languages); read from a file, their size is known and the planner broadcasts them if they are small
    middle = saved(rows.groupBy("band").agg(F.count("*").alias("n_texts"), *(median(m).alias(f"mid_{m}") for m in (*FLOORS, "log_tokens"))), "middle")
    middle = middle.where((F.col("n_texts") >= LEAST_TEXTS) | (F.col("band") == ""))
    apart = F.col("log_tokens") - F.col("mid_log_tokens")
    slope = lambda m: F.when(F.abs(apart) >= 1, (F.col(m) - F.col(f"mid_{m}")) / apart)
    tilts = rows.join(middle, "band").groupBy("band").agg(*(F.coalesce(median(slope(m)), F.lit(0.0)).alias(f"tilt_{m}") for m in TILTED))
    tilted = saved(middle.join(tilts, "band"), "tilted")
    one = F.col("band").contains("|")
    wide = lambda m: F.when(one, F.lit(0.0)).otherwise(F.percentile_approx(_off(m), MIXED_QUANTILE, 10_000) * MIXED_MARGIN)
    half = lambda m: F.greatest(median(_off(m)) * F.lit(1.4826 * band), wide(m), F.lit(1.0))
    deviations = rows.join(tilted, "band").groupBy("band").agg(*(half(m).alias(f"half_{m}") for m in FLOORS))
    return saved(tilted.join(deviations, "band"), "bands")


def judged(measured: DataFrame, band: float = BAND) -> DataFrame:
    """Adds base_failed and kept."""
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    measured = measured.withColumn("base_failed", failed).withColumn("cell", F.concat_ws("|", "script", F.coalesce("lang", F.lit("")))).withColumn("log_tokens", F.log2(F.greatest(F.col("n_tokens"), F.lit(1))))
    passing = measured.where(~F.col("base_failed"))
    found = bands(passing, band)
    # the first band there is: of the cell, the script, all
    cells = passing.groupBy("cell", "script").agg(F.count("*").alias("n")).select("cell", F.posexplode(F.array("cell", "script", F.lit(""))).alias("rank", "band"))
    values = [c for c in found.columns if c not in ("band", "n_texts")]
    chosen = saved(cells.join(found, "band").groupBy("cell").agg(F.min_by(F.struct(*values), "rank").alias("b")).select("cell", "b.*"), "chosen")
    inside = F.lit(True)
    for m in FLOORS:
        inside = inside & F.coalesce(_off(m) <= F.col(f"half_{m}"), F.lit(True))
    return measured.join(chosen, "cell", "left").withColumn("kept", ~F.col("base_failed") & inside).drop("cell", "log_tokens", "text_hash", *values)


def op6_tokenizer_fertility(docs: DataFrame) -> DataFrame:
    measured = saved(with_measures(docs), "fertility")
    return judged(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "script", *(F.round(m, 4).alias(m) for m in FLOORS))
