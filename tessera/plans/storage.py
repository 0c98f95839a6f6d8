"""Sources and sinks: tables written by the library's writers into the shared folder and read again by its readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import readers, writers
from ..sources.storage import shared_dir
from .counts import _SPLIT_SQL, with_split
from .registry import query


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/tessera/round-trip-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def jsonl_round_trip(t):
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = _folder(o.sparkSession)
    writers.write_jsonl(o, path)
    return readers.jsonl(o.sparkSession, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_suppkey % 7 > 0")
def tolerant_jsonl(t):
    s = t("supplier")
    path = _folder(s.sparkSession)
    line = F.to_json(F.struct("s_suppkey", "s_name", "s_acctbal"))
    s.select(F.when(F.col("s_suppkey") % 7 == 0, F.substring(line, 2, 9)).otherwise(line).alias("value")).write.text(path)
    return readers.jsonl(s.sparkSession, path, "s_suppkey long, s_name string, s_acctbal double", tolerant=True)


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_and_orc_round_trip(t):
    c = t("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = _folder(c.sparkSession)
    c.where("c_custkey % 2 = 0").write.option("header", True).csv(f"{path}/csv")
    c.where("c_custkey % 2 = 1").write.orc(f"{path}/orc")
    return readers.csv(c.sparkSession, f"{path}/csv", "c_custkey long, c_name string, c_acctbal double, c_mktsegment string").unionByName(readers.orc(c.sparkSession, f"{path}/orc"))


@query(f"SELECT split, doc_id FROM (SELECT {_SPLIT_SQL} AS split, doc_id FROM documents)")
def split_write(t):
    d = with_split(t("documents").select("doc_id"))
    path = _folder(d.sparkSession)
    writers.write_splits(d.select("doc_id"), d.select("doc_id", F.col("split").alias("partition")), "doc_id", path)
    return d.sparkSession.read.json(path).select(F.col("partition").alias("split"), "doc_id")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def ledger_appends(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber")
    spark, key = rows.sparkSession, ["l_orderkey", "l_linenumber"]
    path = _folder(spark)
    # the second run brings every row again, the third none that is new
    for part in (rows.where("l_orderkey % 2 = 0"), rows, rows.where("l_linenumber = 1")):
        writers.append_ledger(part, path, key)
    return spark.read.schema(rows.schema).parquet(path)


@query("SELECT 'nation' AS part, n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT 'region', r_regionkey, r_name FROM region")
def sealed_release(t):
    n, r = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    spark = n.sparkSession
    path = _folder(spark)
    writers.release({"nation": n, "region": r}, path, card="# Regions", provenance={"tables": ["nation", "region"]})
    writers.verify(spark, path)
    part = lambda name: readers.jsonl(spark, f"{path}/{name}", "id int, name string").select(F.lit(name).alias("part"), "id", "name")
    return part("nation").unionByName(part("region"))


@query("SELECT p_brand AS shard, count(*) AS n, CASE WHEN p_brand < 'Brand#3' THEN 'settled' ELSE 'failed' END AS status FROM part GROUP BY 1")
def sharded_scan(t):
    p = t("part").select("p_partkey", F.col("p_brand").alias("shard"))
    spark = p.sparkSession
    path = _folder(spark)
    p.withColumn("s", F.regexp_replace("shard", "#", "-")).drop("shard").repartition("s").write.partitionBy("s").json(path)
    manifest = p.select("shard").distinct().select(F.concat(F.lit("s="), F.regexp_replace("shard", "#", "-")).alias("shard"), F.col("shard").alias("brand"), F.when(F.col("shard") < "Brand#3", "settled").otherwise("failed").alias("status"))
    rows = readers.sharded(spark, f"{path}/*", "p_partkey long", manifest)
    return rows.groupBy(F.col("brand").alias("shard"), "status").agg(F.count("*").alias("n")).select("shard", "n", "status")


@query("SELECT n_name AS name, sha256(n_name) AS sha256, n_nationkey % 5 > 0 AS there FROM nation")
def blobs_by_digest(t):
    n = t("nation")
    spark = n.sparkSession
    path = _folder(spark)
    for r in n.where("n_nationkey % 5 > 0").select("n_name").collect():  # a file each, of a fixed table of 25 rows
        writers._write_text(spark, f"{path}/{r['n_name']}.txt", r["n_name"])
    wanted = n.select(F.col("n_name").alias("name"), F.sha2("n_name", 256).alias("sha256"))
    return readers.blobs(spark, path, wanted).select("name", "sha256", F.col("content").isNotNull().alias("there"))


@query("""
SELECT r_regionkey AS id, CASE r_regionkey % 3 WHEN 0 THEN 'task' WHEN 1 THEN 'row' ELSE 'unknown' END AS kind FROM region
""")
def documents_by_schema(t):
    r = t("region")
    spark = r.sparkSession
    path = _folder(spark)
    schema = F.when(F.col("r_regionkey") % 3 == 0, "task/1").when(F.col("r_regionkey") % 3 == 1, "row/2")
    r.select(F.to_json(F.struct(schema.alias("schema"), F.col("r_regionkey").alias("id"))).alias("value")).write.text(path)
    out = readers.by_schema(spark.read.text(path), {"task/1": "task", "row/2": "row"})
    return out.select(F.get_json_object("value", "$.id").cast("int").alias("id"), "kind")
