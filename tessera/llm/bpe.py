"""Operator 10: BPE encoding and decoding against a public byte-level vocabulary.

Encoding splits a text by the vocabulary's pattern and merges each piece on its own: symbols form a doubly linked list, a heap
holds (rank, position) of the pairs that may merge, and an entry whose pair has changed since it was pushed is stale and
skipped. Pieces repeat, so each worker remembers the ids of pieces, up to a bound. Decoding concatenates the vocabulary's
strings of the ids and reads the bytes as UTF-8, with U+FFFD for what isn't valid, as the public library does.

Defined results: a null text encodes like an empty one (no ids, empty decoded text); texts of any length are encoded whole, in
pieces; repeated rows give repeated rows; a null doc_id stays null; extra columns are ignored by the query.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: The piece pattern of the byte-level vocabulary (a fixed value of the public format).
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces remembered by a worker; longer pieces are never remembered.
REMEMBERED, LONGEST = 300_000, 64


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge by rank with a heap over a doubly linked list; the leftmost pair goes first among equals."""
    n = len(symbols)
    if n < 2:
        return symbols
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j < 0 or symbols[i] != left or symbols[j] != right:
            continue  # stale: one side has been merged since
        symbols[i] = left + right
        alive[j] = False
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
    return [s for s, live in zip(symbols, alive, strict=True) if live]


class Codec:
    """Encoder and decoder of one vocabulary file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        letters = byte_letters()
        self.letter = [letters[b] for b in range(256)]
        back = {c: b for b, c in letters.items()}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = max([*self.ids.values(), *added.values()]) + 1
        self.strings = [b""] * size
        for token, i in self.ids.items():
            self.strings[i] = bytes(back[c] for c in token)
        for token, i in added.items():
            self.strings[i] = token.encode("utf-8")
        self.added = added
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None
        self.pieces = regex.compile(PIECES).findall
        self.known: dict[str, list[int]] = {}

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece, remembered if it is short."""
        letters = self.letter
        ids = [self.ids[s] for s in merged([letters[b] for b in piece.encode("utf-8")], self.ranks)]
        if len(piece) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        extend, known, piece = out.extend, self.known.get, self.piece
        parts = self.split_added(text) if self.split_added and any(a in text for a in self.added) else (text,)
        for part in parts:
            if part in self.added:
                out.append(self.added[part])
            else:
                for p in self.pieces(part):
                    extend(known(p) or piece(p))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec a worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def with_token_ids(docs: DataFrame, path: str | None = None, text: str = "text", to: str = "token_ids") -> DataFrame:
    """The operator: adds an array of ids to a frame."""
    prepare(docs.sparkSession)
    path = path or vocabulary_path()

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        c = codec(path)
        return pd.Series([c.encode(t) for t in texts])

    return docs.withColumn(to, encode(F.col(text)))


def with_decoded(docs: DataFrame, path: str | None = None, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """The operator's other half: adds the text of an array of ids (null: null)."""
    prepare(docs.sparkSession)
    path = path or vocabulary_path()

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        c = codec(path)
        return pd.Series([None if r is None else c.decode(list(r)) for r in rows])

    return docs.withColumn(to, decode(F.col(ids)))


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes in one pass, so ids never leave the worker."""
    prepare(docs.sparkSession)
    path = path or vocabulary_path()

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        decimal = [str(i) for i in range(len(c.strings))].__getitem__
        for texts in batches:
            rows = []
            for text in texts:
                ids = c.encode(text)
                said = ",".join(map(decimal, ids)).encode("ascii")
                rows.append((len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digests(F.col("text")).alias("r")).select("doc_id", "r.*")


def op10_bpe_round_trip(docs: DataFrame) -> DataFrame:
    return token_digests(docs)
