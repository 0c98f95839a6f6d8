"""Validation and release audits; an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graphs, joins, validation
from .counts import _SPLIT_SQL, with_split
from .registry import query


@query("""
SELECT doc_id, CASE WHEN NOT coalesce(length(text) > 0, false) THEN 'text' WHEN NOT coalesce(lang IN ('en', 'de', 'fr'), false) THEN 'lang' WHEN NOT coalesce(n_chars BETWEEN 50 AND 20000, false) THEN 'n_chars' END AS violation FROM documents
WHERE NOT (coalesce(length(text) > 0, false) AND coalesce(lang IN ('en', 'de', 'fr'), false) AND coalesce(n_chars BETWEEN 50 AND 20000, false))
""")
def row_schema_violations(t):
    rules = [("text", F.length("text") > 0), ("lang", F.col("lang").isin("en", "de", "fr")), ("n_chars", F.col("n_chars").between(50, 20000))]
    return validation.row_violations(t("documents"), ["doc_id"], rules)


@query("SELECT d.doc_id, list_filter([CASE WHEN l.quality IS NULL THEN 'quality' END, CASE WHEN l.toxic IS NULL THEN 'toxic' END], lambda x: x IS NOT NULL) AS missing FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.toxic IS NULL")
def required_meta(t):
    return validation.required_keys(t("documents").select("doc_id").join(t("labels"), "doc_id", "left"), ["doc_id"], ["quality", "toxic"])


@query("SELECT doc_id FROM documents WHERE sha256(text) <> sha256(trim(text))")
def row_hash_binding(t):
    d = t("documents").select("doc_id", "text", F.sha2(F.trim("text"), 256).alias("digest"))
    return validation.rebound(d, ["doc_id"], F.col("text"), "digest")


@query(f"SELECT h AS component, count(DISTINCT split) AS n FROM (SELECT md5(text) AS h, {_SPLIT_SQL} AS split FROM documents) GROUP BY 1 HAVING count(DISTINCT split) > 1")
def component_crosses_split(t):
    d = with_split(t("documents").select("doc_id", F.md5("text").alias("component")))
    return joins.crossing(d, "component", "split").select("component", F.col("n_splits").alias("n"))


@query("SELECT count(DISTINCT lang) AS n FROM documents HAVING count(DISTINCT lang) > 1")
def single_catalog(t):
    return validation.at_most_one(t("documents"), "lang")


@query(f"""
WITH want AS (SELECT DISTINCT source FROM documents), have AS (SELECT DISTINCT source, {_SPLIT_SQL} AS split FROM documents WHERE n_chars > 6000)
SELECT w.source, s.s AS split FROM want w, (VALUES ('train'), ('validation'), ('system_test')) s(s) WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.source = w.source AND h.split = s.s)
""")
def focus_coverage(t):
    have = with_split(t("documents").where("n_chars > 6000").select("doc_id", "source")).select("source", "split").distinct()
    want = t("documents").select("source").distinct().withColumn("split", F.explode(F.array(F.lit("train"), F.lit("validation"), F.lit("system_test"))))
    return joins.missing(want, have, ["source", "split"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def source_permits(t):
    good = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.missing(t("orders").select("o_orderkey", "o_custkey"), good, "o_custkey")


@query("""
SELECT coalesce(a.n_name, b.name) AS name, CASE WHEN b.name IS NULL THEN 'removed' ELSE 'added' END AS difference FROM nation a FULL JOIN (SELECT regexp_replace(s_name, 'Supplier#0+', 'NATION_') AS name FROM supplier) b ON a.n_name = b.name WHERE a.n_name IS NULL OR b.name IS NULL
""")
def contract_drift(t):
    a = t("nation").select(F.col("n_name").alias("name"))
    b = t("supplier").select(F.regexp_replace("s_name", "Supplier#0+", "NATION_").alias("name"))
    return joins.differences(a, b, ["name"], [])


_ADMIT = "CASE WHEN value > 150 THEN 'large' WHEN event_type = 'signup' THEN 'setup' END"


@query(f"""
WITH x AS (SELECT event_id, user_id, {_ADMIT} AS x, coalesce(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 1, false) AS rec,
  sum(CASE WHEN {_ADMIT} IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place FROM events)
SELECT event_id, CASE WHEN x IS NOT NULL THEN 'excluded:' || x WHEN rec THEN 'recovery' ELSE 'plain' END AS category, x IS NULL AND place = 1 AS first_admitted FROM x
""")
def admission_categories(t):
    e = t("events").select("event_id", "user_id", "event_type", "value")
    reason = F.when(F.col("value") > 150, "large").when(F.col("event_type") == "signup", "setup")
    return validation.admitted(e, ["user_id"], ["event_id"], reason, F.col("event_type") == "error").select("event_id", "category", "first_admitted")


@query("SELECT o_custkey, bool_or(o_orderstatus = 'F' AND o_totalprice > 200000) AS witnessed FROM orders GROUP BY 1")
def diagnostic_witness(t):
    passed = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)
    return t("orders").groupBy("o_custkey").agg(F.bool_or(passed).alias("witnessed"))


@query("SELECT p_type AS stage, p_brand AS model, count(*) AS n FROM part WHERE p_size >= 40 GROUP BY 1, 2")
def provenance_recipe(t):
    return t("part").where("p_size >= 40").groupBy(F.col("p_type").alias("stage"), F.col("p_brand").alias("model")).agg(F.count("*").alias("n"))


@query("""
SELECT l_suppkey AS reviewer, bool_and(l_discount < 0.1::DOUBLE) AS qualified, count(*) AS controls FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1
""")
def qualified_reviewers(t):
    c = t("lineitem").where("l_returnflag = 'A'").select(F.col("l_suppkey").alias("reviewer"), (F.col("l_discount") < 0.1).alias("right"))
    return validation.qualified(c, ["reviewer"], "right")


@query("""
SELECT o.o_orderkey, CASE WHEN c.c_custkey IS NULL THEN 'unknown' ELSE 'differs' END AS violation FROM (SELECT o_orderkey, o_custkey, CAST(o_orderkey % 25 AS INTEGER) AS site FROM orders) o LEFT JOIN (SELECT c_custkey, c_nationkey AS site FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey WHERE c.c_custkey IS NULL OR o.site IS DISTINCT FROM c.site
""")
def episode_bindings(t):
    s = t("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 25).cast("int").alias("site"))
    tasks = t("customer").where("c_acctbal > 0").select("c_custkey", F.col("c_nationkey").alias("site"))
    return validation.bindings(s, tasks, "c_custkey", ["site"]).select("o_orderkey", "violation")


@query("""
WITH claims AS (SELECT o_orderpriority AS name, count(*) + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS claimed FROM orders GROUP BY 1), found AS (SELECT o_orderpriority AS name, count(*) AS found FROM orders GROUP BY 1)
SELECT c.name, c.claimed, f.found FROM claims c JOIN found f ON c.name = f.name WHERE c.claimed <> f.found
""")
def recounted_claims(t):
    o = t("orders").select("o_orderpriority")
    claims = o.groupBy(F.col("o_orderpriority").alias("name")).agg((F.count("*") + F.max((F.col("o_orderpriority") == "5-LOW").cast("int"))).alias("value"))
    return validation.recounted(claims, o, "name", "value", "o_orderpriority")


@query(f"""
SELECT 'duplicates' AS "check", (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'leakage', (SELECT count(*) FROM (SELECT h FROM (SELECT md5(text) AS h, {_SPLIT_SQL} AS split FROM documents) GROUP BY h HAVING count(DISTINCT split) > 1))
UNION ALL SELECT 'unlisted', (SELECT count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
UNION ALL SELECT 'lengths', (SELECT count(*) FROM documents WHERE length(text) <> n_chars)
""")
def release_audit(t):
    d = t("documents").select("doc_id", "text", "n_chars")
    return validation.release_audit({
        "duplicates": joins.duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"]),
        "leakage": validation.one_split(with_split(d.select("doc_id", F.md5("text").alias("h"))), "h", "split"),
        "unlisted": validation.unlisted(d.select("doc_id"), t("labels"), "doc_id"),
        "lengths": validation.row_violations(d, ["doc_id"], [("n_chars", F.length("text") == F.col("n_chars"))]),
    })


@query(f"""
SELECT doc_id, split, expected AS partition FROM (SELECT doc_id, {_SPLIT_SQL} AS split, CASE WHEN source = 'src1' THEN 'system_test' ELSE {_SPLIT_SQL} END AS expected FROM documents) WHERE split <> expected
""")
def partition_mismatch(t):
    d = with_split(t("documents").select("doc_id", "source"))
    assigned = d.select("doc_id", F.when(F.col("source") == "src1", "system_test").otherwise(F.col("split")).alias("partition"))
    return validation.wrong_partition(d.select("doc_id", "split"), assigned, "doc_id")


@query("""
SELECT CAST(sum(CASE WHEN n < 12 OR n > 400 THEN 1 ELSE 0 END) AS BIGINT) AS lengths, count(*) - count(DISTINCT h) AS repeated FROM (SELECT length(text) AS n, md5(text) AS h FROM benchmark)
""")
def scenario_validation(t):
    b = t("benchmark").select(F.length("text").alias("n"), F.md5("text").alias("h"))
    return b.agg(F.count_if((F.col("n") < 12) | (F.col("n") > 400)).alias("lengths"), (F.count("*") - F.countDistinct("h")).alias("repeated"))


@query("""
SELECT a.doc_id, a.quality AS first, CASE WHEN a.doc_id % 2 = 0 THEN 1 - a.toxic END AS second FROM labels a
""")
def second_scores(t):
    second = t("labels").where("doc_id % 2 = 0").select("doc_id", (1 - F.col("toxic")).alias("second"))
    return t("labels").select("doc_id", F.col("quality").alias("first")).join(second, "doc_id", "left")


@query("""
SELECT o_custkey, min(n) AS rows FROM (SELECT o_custkey, o_orderpriority, count(*) AS n, bool_and(o_orderstatus = 'F') AS p, bool_or(o_orderstatus = 'F') AS s FROM orders GROUP BY 1, 2) WHERE s GROUP BY 1
""")
def offered_trials(t):
    per = t("orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"), F.bool_or(F.col("o_orderstatus") == "F").alias("some"))
    return per.where("some").groupBy("o_custkey").agg(F.min("n").alias("rows"))


@query("""
SELECT user_id, CASE WHEN count(*) <> count(DISTINCT event_id) THEN 'repeated' WHEN count(*) FILTER (WHERE event_type = 'signup') <> 1 THEN 'dispatch' WHEN count(*) FILTER (WHERE value < 0.05) > 0 THEN 'unsettled' END AS violation FROM events GROUP BY 1
HAVING count(*) <> count(DISTINCT event_id) OR count(*) FILTER (WHERE event_type = 'signup') <> 1 OR count(*) FILTER (WHERE value < 0.05) > 0
""")
def call_controls(t):
    g = t("events").groupBy("user_id").agg((F.count("*") == F.countDistinct("event_id")).alias("unique"), F.count_if(F.col("event_type") == "signup").alias("dispatched"), F.count_if(F.col("value") < 0.05).alias("open"))
    return validation.row_violations(g, ["user_id"], [("repeated", F.col("unique")), ("dispatch", F.col("dispatched") == 1), ("unsettled", F.col("open") == 0)])


@query("""
WITH e AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders), a AS (SELECT l_orderkey AS k, CASE WHEN bool_or(l_linestatus = 'O') THEN 'O' ELSE 'F' END AS v FROM lineitem GROUP BY 1)
SELECT coalesce(e.k, a.k) AS k, CASE WHEN a.k IS NULL THEN 'removed' WHEN e.k IS NULL THEN 'added' ELSE 'changed' END AS difference FROM e FULL JOIN a ON e.k = a.k WHERE e.k IS NULL OR a.k IS NULL OR e.v IS DISTINCT FROM a.v
""")
def attempts_equal_outcomes(t):
    e = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    a = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.when(F.bool_or(F.col("l_linestatus") == "O"), "O").otherwise("F").alias("v"))
    return joins.differences(e, a, ["k"], ["v"]).select("k", "difference")


@query("""
WITH l AS (SELECT c_mktsegment AS identity, c_custkey // 10000 AS slice, sha256(string_agg(CAST(c_custkey AS VARCHAR) || ':' || sha256(c_name), chr(10) ORDER BY c_custkey)) AS digest FROM customer GROUP BY 1, 2)
SELECT identity, sha256(string_agg(CAST(slice AS VARCHAR) || ':' || digest, chr(10) ORDER BY slice)) AS digest FROM l GROUP BY 1
""")
def ordered_digests(t):
    line = F.concat_ws(":", F.col("c_custkey").cast("string"), F.sha2("c_name", 256))
    return graphs.ordered_digest(t("customer"), "c_mktsegment", "c_custkey", line).select(F.col("c_mktsegment").alias("identity"), "digest")


@query("""
SELECT n_regionkey AS component, count(*) FILTER (WHERE n_name IS NOT NULL) AS declared FROM nation GROUP BY 1 HAVING count(*) FILTER (WHERE n_name LIKE '%_1%') = 0
""")
def undeclared_components(t):
    g = t("nation").groupBy(F.col("n_regionkey").alias("component")).agg(F.count("n_name").alias("declared"), F.count_if(F.col("n_name").contains("1")).alias("sources"))
    return g.where("sources = 0").select("component", "declared")


@query("""
SELECT o.o_custkey, count(DISTINCT o.o_orderpriority) AS tasks FROM orders o GROUP BY 1 HAVING count(DISTINCT o.o_orderpriority) > 1
""")
def one_task_per_session(t):
    return t("orders").groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("tasks")).where("tasks > 1")
