"""What the text operators share: reading tables, the shared folder, words, and the two ways of cutting lineage."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word in every contract of this subpackage: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in one Arrow batch; with a few kB a row this keeps a batch in the low MB and still vectorises well.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table through Spark, so that any store Spark can open works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a batch of very long texts still fits into a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``. Where that is unset a local session gets one of our own (tests);
    on a cluster, whose machines share no such folder, that is refused."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Paths written by the innermost open scratch().
_WRITTEN: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("written", default=None)


def _removed(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back: lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "tessera", f"{name}-{uuid.uuid4().hex}")
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What is saved inside goes when the block ends, also by an error; a result that is read later must be saved by `result` from here."""
    token = _WRITTEN.set([])
    kept: list[str] = []

    def result(df: DataFrame, name: str) -> DataFrame:
        out = saved(df, name)
        kept.append(_WRITTEN.get()[-1])
        return out

    try:
        yield result
    finally:
        paths = _WRITTEN.get()
        _WRITTEN.reset(token)
        for path in paths:
            if path not in kept:
                _removed(spark, path)
        if (outer := _WRITTEN.get()) is not None:
            outer.extend(kept)


def as_rows(docs: DataFrame) -> DataFrame:
    """All columns as one struct `row`, so that no column a caller brings along can clash with one an operator adds."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for the jobs that run inside; what was set before comes back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def crc32_mod(column: Column, n: int) -> Column:
    """crc32 of an id's decimal text, modulo n: the fold rule of the learned operators. Null ids count as 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % F.lit(n), F.lit(0))


_RANDOM = np.random.Generator(np.random.PCG64(911))
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_LOWER_BYTE = _BYTE[[c + 32 if 65 <= c <= 90 else c for c in range(256)]]
_IS_SPACE = np.array([c == 0x20 or 0x09 <= c <= 0x0D for c in range(256)])
_BASE = 0x5851F42D4C957F2D
#: Powers of _BASE and of its inverse modulo 2^64, grown to the longest piece seen.
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Longer texts are hashed in pieces, cut at white space, so that the tables of powers stay small.
_PIECE = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_POWERS[0]) < n:
        k = len(_POWERS[0])
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            _POWERS[i] = np.concatenate([_POWERS[i], _POWERS[i] * np.uint64(pow(base, k, 2**64))])
    return _POWERS[0], _POWERS[1]


def spans(data: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of UTF-8 text without a list of them: a 64-bit hash, the start and the length in bytes of each.

    A word's hash is a polynomial over random values of its bytes, the difference of two running sums; with `lower`, A-Z count as a-z.
    """
    if len(data) > _PIECE:
        at, parts = 0, []
        while at < len(data):
            end = min(at + _PIECE, len(data))
            if end < len(data):
                after = np.flatnonzero(_IS_SPACE[np.frombuffer(data, np.uint8, min(_PIECE, len(data) - end), end)])
                while not len(after) and end < len(data):
                    end = min(end + _PIECE, len(data))
                    after = np.flatnonzero(_IS_SPACE[np.frombuffer(data, np.uint8, min(_PIECE, len(data) - end), end)]) if end < len(data) else after
                end += int(after[0]) if len(after) else 0
            h, s, n = _spans(data[at:end], lower)
            parts.append((h, s + at, n))
            at = end
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    return _spans(data, lower)


def _spans(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a = np.frombuffer(data, np.uint8)
    n = len(a)
    outside = np.ones(n + 2, np.int8)
    np.take(_IS_SPACE, a, out=outside[1:-1].view(bool))
    edges = np.flatnonzero(outside[1:] != outside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    powers, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(np.take(_LOWER_BYTE if lower else _BYTE, a) * powers[:n], out=sums[1:])
    lengths = ends - starts
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + lengths.astype(np.uint64)), starts, lengths


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; a shorter text is one run of all its words."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    total = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        total = total * _MULTIPLIER + hashes[k : n - size + 1 + k]
    return mixed(total + np.uint64(size))


