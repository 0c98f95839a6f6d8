"""Operator 5: token ids in fixed-width bit packing.

Every id takes the fewest bits that hold the vocabulary. A file ("shard") is self-contained:

    magic 8 bytes, version u16, bits u16, tokens a block u32, documents u64, tokens u64, blocks u64
    documents x (doc_id i64, tokens u64)          a missing doc_id is the least i64
    (blocks + 1) x u64                            byte offsets of the blocks in the payload
    payload                                       blocks of packed ids, least significant bit first

all little-endian. A block can be found from its offset and unpacked alone, with a few vectorised numpy operations on 64 ids
at a time. Shards are rows of a Parquet table in any store that Spark writes to, so executors need no common file system
besides it; ``export`` gives the bytes of single files.

Documents are written in ascending doc_id order by range partitions; where a document starts among all ids follows from its
place in the shard, the shard's place in the partition (written with it) and one running sum over partitions, whose
number is bounded by the shuffle's.

Defined results: a null text is encoded as an empty one and so holds the end id alone; a null doc_id sorts first; repeated
doc_ids are written one after the other, ordered by the hash of the text and the text; texts of any length are encoded whole, and a shard ends after the
document that fills it; an empty table gives no shard and no row; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import prepare, saved

MAGIC, VERSION = b"TSBITS\r\n", 1
HEADER = struct.Struct("<8sHHIQQQ")
#: Ids in a block (a multiple of 64), ids after which a shard ends, words and pieces remembered by a worker, the longest that are.
BLOCK, SHARD_TOKENS, REMEMBERED, LONGEST = 4096, 1 << 18, 500_000, 64
#: The id that ends each document.
END_ID = 1
NO_ID = -(2**63)


def width(vocabulary: int) -> int:
    """Bits that hold every id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids to packed bytes; 64 ids become `bits` words of 64 bits."""
    n = len(ids)
    rows = np.zeros((-(-n // 64), 64), np.uint64)
    rows.reshape(-1)[:n] = ids
    columns = np.ascontiguousarray(rows.T)
    out = np.zeros((bits, rows.shape[0]), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[word] |= columns[j] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= columns[j] >> np.uint64(64 - shift)
    return out.T.astype("<u8").tobytes()[: -(-n * bits // 8)]


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first n ids of packed bytes."""
    groups = -(-n // 64)
    raw = np.zeros(groups * bits * 8, np.uint8)
    have = np.frombuffer(data, np.uint8, count=min(len(data), len(raw)))
    raw[: len(have)] = have
    words = np.ascontiguousarray(raw.view("<u8").reshape(groups, bits).T)
    out = np.empty((64, groups), np.uint64)
    mask = np.uint64(2**bits - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[word + 1] << np.uint64(64 - shift)
        out[j] = value & mask
    return np.ascontiguousarray(out.T).reshape(-1)[:n].astype(np.uint32)


def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    """One shard file."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    table = np.empty((len(doc_ids), 2), "<i8")
    table[:, 0] = [NO_ID if d is None else d for d in doc_ids]
    table[:, 1] = lengths
    payload = pack(ids, bits)
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.uint64) * np.uint64(BLOCK * bits // 8), np.uint64(len(payload))).astype("<u8")
    return HEADER.pack(MAGIC, VERSION, bits, BLOCK, len(doc_ids), n, blocks) + table.tobytes() + offsets.tobytes() + payload


class Shard:
    """A reader over the bytes of one shard; blocks are unpacked when asked for."""

    def __init__(self, data: bytes):
        magic, version, self.bits, self.block, docs, self.tokens, blocks = HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard of packed token ids")
        at = HEADER.size
        table = np.frombuffer(data, "<i8", 2 * docs, at).reshape(docs, 2)
        at += table.nbytes
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at)
        self.payload = memoryview(data)[at + self.offsets.nbytes :]
        self.doc_ids = [None if d == NO_ID else d for d in table[:, 0].tolist()]
        self.lengths = table[:, 1]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the shard, from the blocks that hold them only."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        data = self.payload[int(self.offsets[first]) : int(self.offsets[last + 1])]
        n = min((last + 1) * self.block, self.tokens) - first * self.block
        return unpack(data, n, self.bits)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.starts[k]), int(self.starts[k + 1]))


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Words that the library's normaliser leaves alone but for lower case: printable and below U+0250, where all are composed.
_PLAIN = re.compile("[!-~¡-ɏ]+").fullmatch
#: The vocabulary's piece pattern, without white space (a fixed value of the public format).
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall


class WordEncoder:
    """The tokenizers library, word by word: its pieces never span white space, so a text's ids are its words' ids in a row.

    Plain words are cut into pieces here and merged by the library's model, piece by piece; all others, and words that may
    hold an added token, go through the whole library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.model = self.tokenizer.model
        letters = byte_letters()
        self.letter = [letters[b] for b in range(256)]
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            mapped = "".join([self.letter[b] for b in piece.encode("utf-8")])
            found = np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
            if len(piece) <= LONGEST:
                self.pieces[piece] = found
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if "<|" in text or not _PLAIN(text):
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            found = b"".join(map(self._piece, _PIECES(text.lower())))
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        words = text.encode("utf-8", "replace").split() if text else []
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            pass
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        known, word = self.known, self._word
        new = set(words).difference(known)
        for w in new:
            known[w] = word(w)
        out = b"".join(map(known.__getitem__, words))
        for w in new:
            if len(w) > LONGEST:
                del known[w]
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder a worker process, with what it remembers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_shards(docs: DataFrame, path: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The writer: (part, seq, before, n_tokens, n_docs, shard) rows, not yet stored. `before` counts the partition's ids before the shard."""
    prepare(docs.sparkSession)
    path = path or vocabulary_path()
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    # the hash lets ranges part the texts of one id, or of none
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_encoder = encoder(path)
        bits, end, part = width(max(own_encoder.size, end_id + 1)), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        seq = before = held = 0
        ids, lengths, packed = [], [], []

        def closed() -> pa.RecordBatch:
            data = shard_bytes(ids, lengths, np.frombuffer(b"".join(packed), "<u4"), bits)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int64()), "before": pa.array([before], pa.int64()), "n_tokens": pa.array([held], pa.int64()), "n_docs": pa.array([len(ids)], pa.int64()), "shard": pa.array([data], pa.binary())})

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = own_encoder.encode(text) + end
                ids.append(doc_id)
                lengths.append(len(own) // 4)
                packed.append(own)
                held += len(own) // 4
                if held >= shard_tokens:
                    yield closed()
                    seq, before, held = seq + 1, before + held, 0
                    ids, lengths, packed = [], [], []
        if ids:
            yield closed()

    return ordered.mapInArrow(run, "part int, seq long, before long, n_tokens long, n_docs long, shard binary")


def read_shards(shards: DataFrame) -> DataFrame:
    """The reader: doc_id, start, n_tokens, ids_crc32 of every document, from stored shards alone."""
    prepare(shards.sparkSession)
    # one row a partition of the writer: bounded by the number of shuffle partitions
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = parts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = shards.join(F.broadcast(base), "part").select((F.col("base") + F.col("before")).alias("first"), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column("first"), batch.column("shard"), strict=True):
                shard = Shard(data.as_py())
                at = first.as_py()
                every = shard.read(0, shard.tokens)
                sums = [zlib.crc32(every[a:b].astype("<u4").tobytes()) for a, b in zip(shard.starts[:-1].tolist(), shard.starts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(shard.doc_ids, pa.int64()), "start": pa.array(shard.starts[:-1] + at, pa.int64()), "n_tokens": pa.array(shard.lengths, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def export(shards: DataFrame, part: int, seq: int) -> bytes | None:
    """The bytes of one shard file."""
    row = shards.where((F.col("part") == part) & (F.col("seq") == seq)).select("shard").first()
    return None if row is None else bytes(row[0])


def op5_bit_packed_ids(docs: DataFrame) -> DataFrame:
    return read_shards(saved(write_shards(docs), "packed-ids"))
