"""Writers: JSON lines, all-or-nothing splits, write-once documents, ledgers, checksums, releases, reports."""

from __future__ import annotations

import contextlib
import hashlib
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import canonical
from ..operators.joins import IntegrityError
from .readers import files, listed


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    if not fs.rename(a, b):
        raise OSError(f"can't rename {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def _write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """One small file. Without `overwrite` the file must not be there: stores create it or refuse in one step."""
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]


@contextlib.contextmanager
def locked(spark: SparkSession, path: str, seconds: float = 60.0):
    """Only one writer at a time holds `path`.lock. A lock that a dead writer left behind must be removed by hand."""
    lock, end = f"{path}.lock", time.monotonic() + seconds
    while True:
        try:
            _write_text(spark, lock, "")
            break
        except Exception as e:
            if "AlreadyExists" not in str(e) and not exists(spark, lock):
                raise
            if time.monotonic() > end:
                raise TimeoutError(f"{lock} is held") from e
            time.sleep(0.05)
    try:
        yield
    finally:
        _delete(spark, lock)


def publish(spark: SparkSession, stage: str, target: str) -> None:
    """A staged folder takes the target's place. If that fails the former target stays, and one that a writer which died left aside comes back."""
    folder, _, name = target.rstrip("/").rpartition("/")
    aside = sorted(x for x in listed(spark, folder) if x.startswith(f"{name}.old-"))
    if aside and not exists(spark, target):
        _rename(spark, f"{folder}/{aside[-1]}", target)
        aside.pop()
    old = f"{target.rstrip('/')}.old-{time.time_ns()}"
    had = exists(spark, target)
    if had:
        _rename(spark, target, old)
    try:
        _rename(spark, stage, target)
    except BaseException:
        if had:
            _rename(spark, old, target)
        raise
    for x in (*(f"{folder}/{x}" for x in aside), *((old,) if had else ())):
        _delete(spark, x)


def write_splits(rows: DataFrame, assignment: DataFrame, on: str, target: str, partition: str = "partition") -> dict[str, int]:
    """Write rows into one folder a partition, or nothing: rows without an assignment are refused before anything is
    written, all partitions are staged first, and the staged folder takes the target's place; what was there stays on failure."""
    spark = rows.sparkSession
    lost = rows.join(assignment, on, "left_anti").select(on).limit(5).collect()
    if lost:
        raise IntegrityError("rows without a partition: " + ", ".join(str(r[on]) for r in lost))
    stage = f"{target.rstrip('/')}.stage-{uuid.uuid4().hex}"
    placed = rows.join(assignment.select(on, partition), on)
    try:
        placed.write.partitionBy(partition).json(stage)
        counts = {r[partition]: r["n"] for r in spark.read.json(stage).groupBy(partition).agg(F.count("*").alias("n")).collect()}
        if sum(counts.values()) != rows.count():
            raise IntegrityError("staged rows differ from the rows given")
        with locked(spark, target.rstrip("/")):
            publish(spark, stage, target)
        return counts
    finally:
        _delete(spark, stage)


def write_once(spark: SparkSession, document: dict, path: str) -> bool:
    """Write a canonical document; a second equal write is a no-op (False), a different one is refused, also by writers at one time."""
    text = canonical(document)
    with locked(spark, path):
        if exists(spark, path):
            if _read_text(spark, path) != text:
                raise IntegrityError(f"{path} holds another document")
            return False
        stage = f"{path}.stage-{uuid.uuid4().hex}"
        _write_text(spark, stage, text)
        _rename(spark, stage, path)
        return True


def append_ledger(df: DataFrame, path: str, key: list[str]) -> DataFrame:
    """Append rows whose key isn't in the ledger yet, once each; what was appended is returned, read from the files appended. Writers take
    turns, so a key is never appended twice."""
    spark = df.sparkSession
    stage = f"{path.rstrip('/')}.stage-{uuid.uuid4().hex}"
    try:
        with locked(spark, path.rstrip("/")):
            new = df.dropDuplicates(key)
            if exists(spark, path):
                new = new.join(spark.read.schema(df.schema).parquet(path).select(*key), key, "left_anti").select(*df.columns)
            new.write.parquet(stage)
            fs, target = _fs(spark, path)
            fs.mkdirs(target)
            parts = sorted(x for x in listed(spark, stage) if x.endswith(".parquet"))
            for x in parts:
                _rename(spark, f"{stage}/{x}", f"{path.rstrip('/')}/{x}")
        return spark.read.schema(df.schema).parquet(*(f"{path.rstrip('/')}/{x}" for x in parts)) if parts else df.limit(0)
    finally:
        _delete(spark, stage)


#: The name of a folder's list of digests.
SUMS = "SHA256SUMS"


def sums(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a SHA256SUMS file, by path relative to the folder."""
    name = F.substring_index("name", "/", -1)
    return files(spark, folder).where(~name.startswith("_") & ~name.startswith(".") & (F.col("name") != SUMS)).orderBy("name").select(F.concat_ws("  ", "sha256", "name").alias("line"))


def seal(spark: SparkSession, folder: str) -> None:
    """Write the folder's SHA256SUMS."""
    lines = [r["line"] for r in sums(spark, folder).collect()]
    _write_text(spark, f"{folder}/{SUMS}", "".join(f"{x}\n" for x in lines), overwrite=True)


def verify(spark: SparkSession, folder: str) -> list[str]:
    """Names that SHA256SUMS lists, after each has been found with its digest; anything else is refused."""
    if not exists(spark, f"{folder}/{SUMS}"):
        raise IntegrityError(f"{folder} has no {SUMS}")
    parted = F.split("value", "  ", 2)
    want = spark.read.text(f"{folder}/{SUMS}").select(F.element_at(parted, 2).alias("name"), F.element_at(parted, 1).alias("want"))
    wrong = want.join(files(spark, folder), "name", "left").where(~F.col("want").eqNullSafe(F.col("sha256"))).select("name").limit(5).collect()
    if wrong:
        raise IntegrityError("digests differ: " + ", ".join(sorted(r["name"] for r in wrong)))
    return sorted(r["name"] for r in want.collect())


def release(parts: dict[str, DataFrame], folder: str, card: str | None = None, provenance: dict | None = None) -> DataFrame:
    """Write the parts of a release side by side, with each one's schema, the card, the provenance and the list of digests, and return its
    manifest: part, file, bytes and digest."""
    spark = next(iter(parts.values())).sparkSession
    manifest = None
    for name, df in parts.items():
        write_jsonl(df, f"{folder}/{name}", "errorifexists")
        _write_text(spark, f"{folder}/{name}.schema.json", df.schema.json())
        found = files(spark, f"{folder}/{name}", "part-*").select(F.lit(name).alias("part"), "name", "length", "sha256")
        manifest = found if manifest is None else manifest.unionByName(found)
    if card is not None:
        _write_text(spark, f"{folder}/README.md", card)
    if provenance is not None:
        _write_text(spark, f"{folder}/PROVENANCE.json", canonical(provenance))
    seal(spark, folder)
    return manifest


def digested(body: dict) -> dict:
    """A report body with the digest of its own content under `report_sha256`."""
    return body | {"report_sha256": hashlib.sha256(canonical(body).encode("utf-8")).hexdigest()}


def still_digested(report: dict) -> bool:
    """Whether a report's digest is that of the rest of it."""
    return digested({k: v for k, v in report.items() if k != "report_sha256"}) == report


def markdown(df: DataFrame, title: str, most: int = 200) -> str:
    """A small aggregate as a table; a report isn't a data sink, so more than `most` rows are refused."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many rows for a report")
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)]) + "\n"
