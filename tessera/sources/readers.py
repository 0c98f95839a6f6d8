"""Readers: JSON lines (strict and tolerant), ordered multi-file scans, checksummed bundles, tensor headers, blobs, config."""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import IntegrityError


def jsonl(spark: SparkSession, path, schema: str, tolerant: bool = False) -> DataFrame:
    """One JSON object a line under an explicit schema; blank lines are skipped. A malformed line fails the scan, or is dropped if tolerant."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").json(path)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []


def _qualified(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def ordered_jsonl(spark: SparkSession, path, schema: str) -> DataFrame:
    """Rows of many files with the file each comes from (its whole path), for scans in sorted file order."""
    return jsonl(spark, path, schema).withColumn("file", F.col("_metadata.file_path")).orderBy("file")


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(name, length, sha256) of a folder's files by path relative to it; contents are hashed where they are read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    name = F.substring("path", len(_qualified(spark, folder).rstrip("/")) + 2, 2**31 - 1)
    return found.select(name.alias("name"), "length", F.sha2("content", 256).alias("sha256"))


def checked_bundle(spark: SparkSession, folder: str, members: dict[str, str], sums: DataFrame) -> dict[str, DataFrame]:
    """Members of a bundle as frames, after every file's digest has been compared with sums (name, sha256). Rows bear the bundle's digest,
    that of its sorted list of digests and names, as bundle_sha256."""
    have = files(spark, folder)
    wrong = sums.alias("s").join(have.alias("h"), "name", "left").where(~F.col("s.sha256").eqNullSafe(F.col("h.sha256"))).select("name").limit(5).collect()
    if wrong:
        raise IntegrityError("digests differ: " + ", ".join(sorted(r["name"] for r in wrong)))
    # a bundle's list of files is configuration-sized
    lines = sorted(f"{r['sha256']}  {r['name']}" for r in sums.select("name", "sha256").distinct().collect())
    bundle = hashlib.sha256("\n".join(lines).encode("utf-8")).hexdigest()
    return {name: jsonl(spark, f"{folder}/{name}", schema).withColumn("bundle_sha256", F.lit(bundle)) for name, schema in members.items()}


def blobs(spark: SparkSession, folder: str, wanted: DataFrame, key: str = "sha256") -> DataFrame:
    """Contents looked up by digest."""
    found = spark.read.format("binaryFile").load(folder).select(F.sha2("content", 256).alias(key), "content")
    return wanted.join(found, key, "left")


def tensor_headers(spark: SparkSession, folder: str) -> DataFrame:
    """(name, tensors, parameters) from the JSON headers of tensor files: eight bytes of length, then the header."""

    @F.pandas_udf("tensors int, parameters long")
    def header(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for contents in batches:
            rows = []
            for data in contents:
                try:
                    (n,) = struct.unpack_from("<Q", data)
                    entries = {k: v for k, v in json.loads(bytes(data[8 : 8 + n])).items() if k != "__metadata__"}
                    total = 0
                    for v in entries.values():
                        size = 1
                        for d in v["shape"]:
                            size *= d
                        total += size
                    rows.append((len(entries), total))
                except (struct.error, ValueError, KeyError, TypeError):
                    rows.append((None, None))
            yield pd.DataFrame(rows, columns=["tensors", "parameters"]).astype("Int64")

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.safetensors").load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), header("content").alias("h")).select("name", "h.*")


def by_schema(df: DataFrame, kinds: dict[str, str], column: str = "value") -> DataFrame:
    """Documents of several kinds told apart by their `schema` field: adds kind, `unknown` for others."""
    schema = F.get_json_object(column, "$.schema")
    out = None
    for name, kind in kinds.items():
        out = F.when(schema == name, kind) if out is None else out.when(schema == name, kind)
    return df.withColumn("kind", out.otherwise("unknown"))


def sharded(spark: SparkSession, path: str, schema: str, manifest: DataFrame) -> DataFrame:
    """Rows of shard files joined to their manifest by shard, the name of the folder they lie in."""
    rows = jsonl(spark, path, schema).withColumn("shard", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    return rows.join(manifest, "shard")


def strict_config(text: str, required: dict, optional: dict | None = None, kind: str = "json") -> dict:
    """A JSON or YAML configuration whose keys must be known and of the right type. A type may be a pair of dicts (required, optional), for
    nested keys; a fault names its dotted path. YAML needs its library."""
    if kind == "yaml":
        import yaml

        found = yaml.safe_load(text)
    else:
        found = json.loads(text)
    _checked(found, required, optional or {}, "")
    return found


def _checked(found, required: dict, optional: dict, at: str) -> None:
    if not isinstance(found, dict):
        raise ValueError(f"wrong types: {at.rstrip('.') or 'the document'}")
    every = required | optional
    names = lambda keys: ", ".join(f"{at}{k}" for k in sorted(keys, key=str))
    if unknown := set(found) - set(every):
        raise ValueError(f"unknown keys: {names(unknown)}")
    if missing := set(required) - set(found):
        raise ValueError(f"missing keys: {names(missing)}")
    plain = {k: v for k, v in found.items() if not isinstance(every[k], tuple)}
    if wrong := [k for k, v in plain.items() if not isinstance(v, every[k]) or isinstance(v, bool) and every[k] is not bool]:
        raise ValueError(f"wrong types: {names(wrong)}")
    for k in set(found) - set(plain):
        _checked(found[k], *every[k], f"{at}{k}.")


def snapshot(spark: SparkSession, path: str, sql: str, schema: str) -> DataFrame:
    """Rows of one read-only transaction of a local SQLite store. For small control stores on the driver; `jdbc` is for servers."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        rows = db.execute(sql).fetchall()
    return spark.createDataFrame(rows, schema)


def jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, low: int = 0, high: int = 0, parts: int = 1, **options) -> DataFrame:
    """A server's table, read in `parts` ranges of a numeric column at a time; filters and columns are pushed down."""
    read = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if column:
        read = read.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return read.load()


def csv(spark: SparkSession, path, schema: str, header: bool = True, tolerant: bool = False) -> DataFrame:
    """Separated values under an explicit schema. A malformed line fails the scan, or is dropped if tolerant."""
    return spark.read.schema(schema).option("header", header).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").csv(path)


def orc(spark: SparkSession, path) -> DataFrame:
    return spark.read.orc(path)


def kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic as a stream of (key, value, topic, partition, offset, timestamp); needs Spark's connector on the class path."""
    return spark.readStream.format("kafka").options(subscribe=topic, **{"kafka.bootstrap.servers": servers}, **options).load()
