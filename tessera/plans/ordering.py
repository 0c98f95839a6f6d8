"""Windows, top-k, packing, draws and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import position
from ..operators import joins, windows
from .registry import position_sql, query


@query("""
SELECT event_id, coalesce(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 1, false) AS recovering FROM events
""")
def recovery_flag(t):
    return t("events").select("event_id", windows.earlier_failure(None, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error").alias("recovering"))


@query("""
WITH v AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view'), p AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase'),
x AS (SELECT p.event_id, p.value, v.event_id AS revision FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts)
SELECT event_id, revision, NOT coalesce(revision % 2 = 0, false) AS stale FROM x
""")
def stale_verification_asof(t):
    e = t("events")
    right = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("revision"))
    out = joins.asof(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), right, ["user_id"], "ts", "at", ["revision"])
    return out.select("event_id", "revision", (~F.coalesce(F.col("revision") % 2 == 0, F.lit(False))).alias("stale"))


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders WHERE o_orderstatus = 'F') WHERE r = 1
""")
def first_admitted_attempt(t):
    o = t("orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_orderdate")
    return windows.first_per(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def latest_decision(t):
    return windows.first_per(t("orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], [F.col("o_orderkey").desc()])


@query("""
WITH s AS (SELECT c_custkey, c_nationkey, c_mktsegment, CAST(floor((row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) - 1) / 4) AS INTEGER) AS shard_in_key FROM customer)
SELECT c_custkey, shard_in_key, CAST(dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, shard_in_key) AS INTEGER) AS shard FROM s
""")
def shard_plan(t):
    c = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return windows.packed(c, ["c_nationkey", "c_mktsegment"], [F.col("c_custkey")], 4).select("c_custkey", "shard_in_key", "shard")


@query("SELECT s_suppkey, CAST((row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) % 3 AS INTEGER) AS lane FROM supplier")
def lane_assignment(t):
    return windows.lanes(t("supplier"), ["s_nationkey"], ["s_suppkey"], 3).select("s_suppkey", "lane")


@query(f"""
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {position_sql('quota', 'doc_id')}, doc_id) AS place FROM documents) WHERE place <= CASE lang WHEN 'en' THEN 20 ELSE 5 END
""")
def quota_in_hash_order(t):
    d = t("documents").select("doc_id", "lang").withColumn("p", position("quota", F.col("doc_id")))
    return windows.asked_quota(d, ["lang"], ["p", "doc_id"], F.when(F.col("lang") == "en", 20).otherwise(5)).select("doc_id", "lang")


@query("""
WITH c AS (SELECT s_nationkey, l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'F') AS s FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2), w AS (SELECT *, s / n::DOUBLE AS p, 1.64485::DOUBLE AS z FROM c),
f AS (SELECT *, greatest((p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n), 0) AS low FROM w)
SELECT l_returnflag AS focus, s_nationkey AS teacher, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY round(low, 9) DESC, s_nationkey) AS r FROM f) WHERE r <= 5
""")
def teacher_routes(t):
    from ..functions.stats import wilson

    j = t("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").join(t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    c = j.groupBy("s_nationkey", "l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("s"))
    c = c.withColumn("low", F.round(wilson(F.col("s"), F.col("n"))[0], 9))
    return windows.first_per(c, ["l_returnflag"], [F.col("low").desc(), F.col("s_nationkey")], 5, "rank").select(F.col("l_returnflag").alias("focus"), F.col("s_nationkey").alias("teacher"), "rank")


@query("SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS r FROM documents WHERE n_chars <= 5000) WHERE r <= 3")
def topk_shortest(t):
    d = t("documents").where("n_chars <= 5000").select("source", "doc_id", "n_chars")
    return windows.first_per(d, ["source"], [F.col("n_chars"), F.col("doc_id")], 3)


@query("SELECT user_id, arg_min(value, event_id) AS first_value, arg_max(value, event_id) AS last_value FROM events WHERE event_type = 'view' GROUP BY 1")
def first_and_last(t):
    return t("events").where("event_type = 'view'").groupBy("user_id").agg(F.min_by("value", "event_id").alias("first_value"), F.max_by("value", "event_id").alias("last_value"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey")
def sorted_records(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, sha256(CAST(o_orderkey AS VARCHAR)) LIMIT 50")
def topk_by_digest(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), F.sha2(F.col("o_orderkey").cast("string"), 256)).limit(50)


@query("SELECT doc_id FROM documents ORDER BY sha256('7:' || CAST(doc_id AS VARCHAR)) LIMIT 100")
def seeded_sample(t):
    return t("documents").select("doc_id").orderBy(F.sha2(F.concat(F.lit("7:"), F.col("doc_id").cast("string")), 256)).limit(100)


@query("""
SELECT user_id, string_agg(event_type, ',' ORDER BY sha256('3:' || event_type)) AS shuffled FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1
""")
def shuffled_names(t):
    g = t("events").groupBy("user_id").agg(F.collect_set("event_type").alias("s"))
    keyed = F.array_sort(F.transform("s", lambda x: F.struct(F.sha2(F.concat(F.lit("3:"), x), 256).alias("h"), x.alias("x"))))
    return g.select("user_id", F.array_join(F.transform(keyed, lambda k: k["x"]), ",").alias("shuffled"))


_P = position_sql("model", "o_orderkey")


@query(f"SELECT o_orderkey, CASE WHEN {_P} < 0.5::DOUBLE THEN 'a' WHEN {_P} < 0.8::DOUBLE THEN 'b' ELSE 'c' END AS model FROM orders")
def weighted_choice(t):
    return t("orders").select("o_orderkey", windows.weighted_choice(None, position("model", F.col("o_orderkey")), [("a", 5), ("b", 3), ("c", 2)]).alias("model"))


@query("""
SELECT user_id, event_id, event_type = 'purchase' AS accepted, CAST(before AS BIGINT) AS accepted_before FROM (SELECT *, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events) WHERE before < 3
""")
def early_stop_waves(t):
    e = t("events").select("user_id", "event_id", "event_type")
    return windows.accepted_up_to(e, ["user_id"], ["event_id"], F.col("event_type") == "purchase", 3).select("user_id", "event_id", "accepted", "accepted_before")


@query("""
SELECT l_orderkey, bool_or(l_linenumber = m AND l_returnflag = 'N') AS verified_on_last, bool_or(l_returnflag = 'R') AS invoked FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) GROUP BY 1
""")
def verified_delivery(t):
    x = t("lineitem").groupBy("l_orderkey").agg(F.max(F.struct("l_linenumber", (F.col("l_returnflag") == "N").alias("ok"))).alias("m"), F.bool_or(F.col("l_returnflag") == "R").alias("invoked"))
    return x.select("l_orderkey", F.col("m.ok").alias("verified_on_last"), "invoked")


@query("""
SELECT l_returnflag AS focus FROM (SELECT DISTINCT l_returnflag FROM lineitem) WHERE l_returnflag NOT IN (SELECT l_returnflag FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1 HAVING count(*) > 10000)
""")
def unqualified_focuses(t):
    good = t("lineitem").where("l_linestatus = 'F'").groupBy("l_returnflag").agg(F.count("*").alias("n")).where("n > 10000")
    return joins.missing(t("lineitem").select("l_returnflag").distinct(), good, "l_returnflag").withColumnRenamed("l_returnflag", "focus")


@query("SELECT doc_id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def union_all(t):
    return t("documents").select("doc_id", "text").unionByName(t("benchmark").select(F.col("item_id").alias("doc_id"), "text"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def group_intersection(t):
    return t("customer").select(F.col("c_nationkey").alias("k")).intersect(t("supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def group_difference(t):
    o = t("orders")
    return o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).subtract(o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def required_unique(t):
    return joins.duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT user_id, event_type FROM events GROUP BY 1, 2")
def salvage_dedup(t):
    return t("events").select("user_id", "event_type").dropDuplicates(["user_id", "event_type"])


@query("""
SELECT c_custkey, m[(CAST(c_custkey AS BIGINT) % len(m)) + 1] AS mapped FROM customer, (SELECT list_sort(list(DISTINCT p_type)) AS m FROM part)
""")
def rebased_models(t):
    names = t("part").agg(F.array_sort(F.collect_set("p_type")).alias("m"))  # one row: the list of generators
    return t("customer").crossJoin(names).select("c_custkey", F.element_at("m", (F.col("c_custkey") % F.size("m") + 1).cast("int")).alias("mapped"))
