"""Joins: integrity, semi and anti, as-of, outer differences, completeness, pairs of arms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins
from .registry import query


@query("""
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_custkey, o.o_orderpriority FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def collect_join(t):
    right = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    return joins.checked_join(t("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), right, "l_orderkey", "lines")


@query("SELECT c.c_custkey, n.n_name, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey")
def config_lookup(t):
    # nation and region are fixed dimensions; the planner broadcasts them from their statistics
    c = t("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return c.join(t("nation"), "n_nationkey").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select("c_custkey", "n_name", "r_name")


@query("SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def missing_task_anti(t):
    return joins.missing(t("documents").select("doc_id", "source"), t("labels"), "doc_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def kept_sessions_semi(t):
    lines = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.kept(t("orders").select("o_orderkey", "o_custkey"), lines, "o_orderkey")


@query("""
WITH a AS (SELECT doc_id, quality AS v FROM labels WHERE doc_id % 3 < 2), b AS (SELECT doc_id, toxic AS v FROM labels WHERE doc_id % 3 > 0)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NOT NULL THEN b.v ELSE a.v END AS v FROM a FULL JOIN b ON a.doc_id = b.doc_id
""")
def rejudged_units(t):
    a = t("labels").where("doc_id % 3 < 2").select("doc_id", F.col("quality").alias("v"))
    b = t("labels").where("doc_id % 3 > 0").select("doc_id", F.col("toxic").alias("v"))
    return joins.replaced(a, b, ["doc_id"], ["v"])


@query("""
SELECT a.event_id, b.event_id AS revision, b.value AS revision_value FROM (SELECT * FROM events WHERE event_type = 'purchase') a
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b ON a.user_id = b.user_id AND a.ts >= b.ts
""")
def source_revision_asof(t):
    e = t("events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("revision"), F.col("value").alias("revision_value"))
    return joins.asof(left, right, ["user_id"], "ts", "at", ["revision", "revision_value"]).select("event_id", "revision", "revision_value")


@query("""
SELECT e.event_id, f.first_value FROM events e JOIN (SELECT user_id, arg_min(value, event_id) AS first_value FROM events WHERE event_type = 'view' GROUP BY 1) f ON e.user_id = f.user_id WHERE e.event_type = 'click'
""")
def original_reproduction(t):
    e = t("events")
    first = e.where("event_type = 'view'").groupBy("user_id").agg(F.min_by("value", "event_id").alias("first_value"))
    return e.where("event_type = 'click'").join(first, "user_id").select("event_id", "first_value")


@query("""
SELECT l.doc_id, coalesce(b.grade, l.quality) AS grade FROM labels l LEFT JOIN (SELECT doc_id, 1 - toxic AS grade FROM labels WHERE doc_id % 4 = 0) b ON l.doc_id = b.doc_id
""")
def human_override(t):
    base = t("labels").select("doc_id", F.col("quality").alias("grade"))
    return joins.overridden(base, t("labels").where("doc_id % 4 = 0").select("doc_id", (1 - F.col("toxic")).alias("grade")), "doc_id", "grade")


@query("""
WITH a AS (SELECT n_nationkey AS k, n_name AS v FROM nation WHERE n_nationkey < 20), b AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 4 = 0 THEN 'other' ELSE n_name END AS v FROM nation WHERE n_nationkey > 3)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'removed' WHEN a.k IS NULL THEN 'added' ELSE 'changed' END AS difference, a.v AS before_v, b.v AS after_v
FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v
""")
def vocabulary_diff(t):
    n = t("nation")
    a = n.where("n_nationkey < 20").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
    b = n.where("n_nationkey > 3").select(F.col("n_nationkey").alias("k"), F.when(F.col("n_nationkey") % 4 == 0, "other").otherwise(F.col("n_name")).alias("v"))
    return joins.differences(a, b, ["k"], ["v"])


@query("""
WITH x AS (SELECT r_regionkey AS r, i AS attempt FROM region, unnest(range(0, 6)) u(i)), y AS (SELECT DISTINCT n_regionkey AS r, CAST(n_nationkey // 5 AS BIGINT) AS attempt FROM nation)
SELECT r, attempt, 'absent' AS problem FROM (SELECT CAST(r AS INTEGER) AS r, attempt FROM x EXCEPT ALL SELECT r, attempt FROM y)
UNION ALL SELECT r, attempt, 'unexpected' FROM (SELECT r, attempt FROM y EXCEPT ALL SELECT CAST(r AS INTEGER), attempt FROM x)
""")
def expected_vs_actual(t):
    x = t("region").select(F.col("r_regionkey").alias("r"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(5).cast("bigint"))).alias("attempt"))
    y = t("nation").select(F.col("n_regionkey").alias("r"), F.floor(F.col("n_nationkey") / 5).alias("attempt")).distinct()
    return joins.completeness(x, y)


@query("""
SELECT source, count(DISTINCT lang) AS n_splits, string_agg(DISTINCT lang, ',' ORDER BY lang) AS splits FROM documents GROUP BY source HAVING count(DISTINCT lang) > 1
""")
def leakage_pairs(t):
    return joins.crossing(t("documents").select("source", "lang"), "source", "lang")


@query("""
SELECT h AS hash, count(DISTINCT source) AS n FROM (SELECT md5(text) AS h, source FROM documents) GROUP BY h HAVING count(DISTINCT source) > 1
""")
def duplicate_across_components(t):
    return joins.crossing(t("documents").select(F.md5("text").alias("hash"), "source"), "hash", "source").select("hash", F.col("n_splits").alias("n"))


@query("""
SELECT a.doc_id, a.candidate, a.s AS first, b.s AS second FROM (SELECT doc_id, 'quality' AS candidate, quality AS s FROM labels UNION ALL SELECT doc_id, 'toxic', toxic FROM labels) a
JOIN (SELECT doc_id, 'quality' AS candidate, 1 - toxic AS s FROM labels WHERE doc_id % 2 = 0) b ON a.doc_id = b.doc_id AND a.candidate = b.candidate
""")
def rater_pairs(t):
    a = t("labels").select("doc_id", F.create_map(F.lit("quality"), F.col("quality"), F.lit("toxic"), F.col("toxic")).alias("scores"))
    b = t("labels").where("doc_id % 2 = 0").select("doc_id", F.create_map(F.lit("quality"), 1 - F.col("toxic")).alias("scores"))
    return joins.score_pairs(a, b, ["doc_id"])


@query("""
SELECT n.n_nationkey, coalesce(c.n, 0) AS n_children FROM nation n LEFT JOIN (SELECT n_nationkey // 3 AS p, count(*) AS n FROM nation WHERE n_nationkey > 0 GROUP BY 1) c ON n.n_nationkey = c.p
""")
def operation_children(t):
    n = t("nation").select("n_nationkey", F.expr("case when n_nationkey > 0 then n_nationkey div 3 end").cast("int").alias("parent"))
    return joins.children(n, "n_nationkey", "parent").select("n_nationkey", "n_children")


@query("""
SELECT e.user_id, e.event_id, s.first_at FROM events e JOIN (SELECT user_id, CAST(date_trunc('day', ts) AS DATE) AS d, min(ts) AS first_at FROM events GROUP BY 1, 2) s ON e.user_id = s.user_id AND CAST(date_trunc('day', e.ts) AS DATE) = s.d WHERE e.event_type = 'error'
""")
def episode_sessions(t):
    e = t("events").withColumn("d", F.to_date("ts"))
    s = e.groupBy("user_id", "d").agg(F.min("ts").alias("first_at"))
    return e.where("event_type = 'error'").join(s, ["user_id", "d"]).select("user_id", "event_id", "first_at")


@query("""
SELECT l.l_orderkey, l.l_linenumber, r.r_name FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey WHERE l.l_quantity >= 45
""")
def chained_lookups(t):
    lines = t("lineitem").where("l_quantity >= 45").select("l_orderkey", "l_linenumber")
    o = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    c = t("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return lines.join(o, "l_orderkey").join(c, "c_custkey").join(t("nation"), "n_nationkey").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select("l_orderkey", "l_linenumber", "r_name")


@query("""
SELECT a.user_id, a.n AS base, b.n AS trained FROM (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1) a JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) b ON a.user_id = b.user_id WHERE a.n <> b.n
""")
def attempts_that_differ(t):
    count = lambda kind, name: t("events").where(F.col("event_type") == kind).groupBy("user_id").agg(F.count("*").alias(name))
    return count("view", "base").join(count("click", "trained"), "user_id").where("base <> trained")


@query("""
SELECT l_suppkey, round(avg(l_discount) FILTER (WHERE l_returnflag = 'A'), 6) AS a, round(avg(l_discount) FILTER (WHERE l_returnflag = 'R'), 6) AS r FROM lineitem GROUP BY l_suppkey
""")
def paired_arm_scores(t):
    p = joins.arms(t("lineitem").select("l_suppkey", "l_returnflag", "l_discount"), ["l_suppkey"], "l_returnflag", ["A", "R"], "l_discount")
    return p.select("l_suppkey", F.round("A", 6).alias("a"), F.round("R", 6).alias("r"))


@query("""
SELECT l.l_returnflag, round(sum(l.l_quantity * p.p_retailprice), 2) AS spend FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1
""")
def priced_usage(t):
    prices = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return t("lineitem").select("l_partkey", "l_quantity", "l_returnflag").join(prices, "l_partkey").groupBy("l_returnflag").agg(F.round(F.sum(F.col("l_quantity") * F.col("p_retailprice")), 2).alias("spend"))


@query("SELECT count(DISTINCT e.user_id) AS committed, count(*) AS rows FROM events e WHERE e.event_type = 'click' AND e.user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 150)")
def committed_candidates(t):
    keys = t("events").where("event_type = 'purchase' and value > 150").select("user_id").distinct()
    return joins.kept(t("events").where("event_type = 'click'"), keys, "user_id").agg(F.countDistinct("user_id").alias("committed"), F.count("*").alias("rows"))


@query("SELECT n.n_name, r.r_name, i AS site FROM nation n, region r, unnest(range(0, 2)) u(i) WHERE r.r_regionkey < 2")
def job_cross_product(t):
    # a product of configuration lists, which are fixed in size
    r = t("region").where("r_regionkey < 2").select("r_name", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))).alias("site"))
    return t("nation").select("n_name").crossJoin(r)


@query("""
SELECT s AS skill, k AS kind, i AS idx, substr(sha256(s || chr(10) || k || chr(10) || CAST(i AS VARCHAR)), 1, 16) AS family FROM (SELECT DISTINCT p_type AS s FROM part), (VALUES ('direct'), ('oblique')) v(k), unnest(range(0, 3)) u(i)
UNION ALL SELECT 'none', 'none', i, substr(sha256('none' || chr(10) || 'none' || chr(10) || CAST(i AS VARCHAR)), 1, 16) FROM unnest(range(0, 5)) u(i)
""")
def family_product(t):
    skills = t("part").select(F.col("p_type").alias("skill")).distinct()
    kinds = skills.withColumn("kind", F.explode(F.array(F.lit("direct"), F.lit("oblique")))).withColumn("idx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint"))))
    none = skills.sparkSession.range(5).select(F.lit("none").alias("skill"), F.lit("none").alias("kind"), F.col("id").alias("idx"))
    every = kinds.unionByName(none)
    return every.withColumn("family", F.substring(F.sha2(F.concat_ws("\n", "skill", "kind", F.col("idx").cast("string")), 256), 1, 16))


@query("""
WITH last AS (SELECT user_id, arg_max(event_id, event_id) AS last_start FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT user_id, last_start FROM last
""")
def last_start(t):
    return t("events").where("event_type = 'signup'").groupBy("user_id").agg(F.max("event_id").alias("last_start"))


@query("""
SELECT c.c_custkey, count(o.o_orderkey) = 0 OR coalesce(bool_or(o.o_orderstatus = 'P'), false) AS lost FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY 1
""")
def lost_tasks(t):
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_orderstatus") == "P").alias("failed"))
    return t("customer").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("failed", F.lit(True)).alias("lost"))


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def settled_tasks(t):
    return t("orders").where("o_orderstatus = 'F'").select("o_custkey").distinct()


@query("""
WITH owner AS (SELECT o_orderkey AS episode, o_custkey AS item FROM orders), d AS (SELECT l_orderkey AS episode, arg_max(l_returnflag, l_linenumber) AS decision, max(l_linenumber) AS receipt FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2) GROUP BY 1)
SELECT o.item, o.episode, d.decision, d.receipt FROM owner o JOIN d ON o.episode = d.episode
""")
def final_decisions(t):
    once = t("lineitem").where("l_linestatus = 'F'").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("f"))
    d = once.groupBy(F.col("l_orderkey").alias("episode")).agg(F.max_by("f", "l_linenumber").alias("decision"), F.max("l_linenumber").alias("receipt"))
    return t("orders").select(F.col("o_orderkey").alias("episode"), F.col("o_custkey").alias("item")).join(d, "episode")
