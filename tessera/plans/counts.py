"""Aggregations: statistics, ledgers, agreement, intervals, deficits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats
from ..functions.hashing import position
from ..operators import aggregates, filters
from .registry import position_sql, query

_PLACE = position_sql("split", "doc_id")
_SPLIT_SQL = f"CASE WHEN {_PLACE} < 0.7::DOUBLE THEN 'train' WHEN {_PLACE} < 0.85::DOUBLE THEN 'validation' ELSE 'system_test' END"


def with_split(df):
    place = position("split", F.col("doc_id"))
    return df.withColumn("split", F.when(place < 0.7, "train").when(place < 0.85, "validation").otherwise("system_test"))


@query(f"""
SELECT split, count(*) AS rows, count(DISTINCT source) AS sources, count(DISTINCT lang) AS langs, count(*) FILTER (WHERE n_chars > 2400) AS partial FROM (SELECT *, {_SPLIT_SQL} AS split FROM documents) GROUP BY split
""")
def split_stats(t):
    d = with_split(t("documents").select("doc_id", "source", "lang", "n_chars"))
    return d.groupBy("split").agg(F.count("*").alias("rows"), F.countDistinct("source").alias("sources"), F.countDistinct("lang").alias("langs"), F.count_if(F.col("n_chars") > 2400).alias("partial"))


@query(f"""
WITH d AS (SELECT *, {_SPLIT_SQL} AS split FROM documents)
SELECT split, 'lang' AS field, lang AS value, count(*) AS n FROM d GROUP BY 1, 3 UNION ALL SELECT split, 'source', source, count(*) FROM d GROUP BY 1, 3
""")
def split_histograms(t):
    return aggregates.long_histogram(with_split(t("documents").select("doc_id", "source", "lang")), "split", ["lang", "source"])


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def task_outcomes(t):
    return aggregates.histogram(t("orders").withColumnRenamed("o_orderstatus", "status"), "status")


@query("""
SELECT v.s AS status, count(o.o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) v(s) LEFT JOIN orders o ON o.o_orderstatus = v.s GROUP BY 1
""")
def counts_with_zeros(t):
    return aggregates.with_all(aggregates.histogram(t("orders").withColumnRenamed("o_orderstatus", "status"), "status"), ["F", "O", "P", "X"], "status")


@query("""
WITH p AS (SELECT doc_id % 5 AS a, (doc_id * 7 + length(text)) % 5 AS b FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id % 5, doc_id % 5 FROM documents WHERE doc_id % 3 <> 0),
n AS (SELECT count(*) AS n FROM p), r AS (SELECT a, count(*) AS c FROM p GROUP BY 1), c AS (SELECT b, count(*) AS c FROM p GROUP BY 1)
SELECT CAST((SELECT n FROM n) AS BIGINT) AS pairs, round(1 - (SELECT sum(pow((a - b) / 4.0::DOUBLE, 2)) FROM p) / (SELECT sum(pow((r.a - c.b) / 4.0::DOUBLE, 2) * r.c * c.c) / (SELECT n FROM n) FROM r, c), 4) AS kappa
""")
def weighted_kappa(t):
    d = t("documents").select("doc_id", "text")
    a = F.col("doc_id") % 5
    b = F.when(F.col("doc_id") % 3 == 0, (F.col("doc_id") * 7 + F.length("text")) % 5).otherwise(a)
    return stats.weighted_kappa(d.select(a.alias("a"), b.alias("b")), "a", "b")


@query("SELECT round(avg(CASE WHEN quality = 1 - toxic THEN 1.0::DOUBLE ELSE 0 END), 6) AS agreement, count(*) AS pairs FROM labels")
def exact_agreement(t):
    return t("labels").agg(F.round(F.avg((F.col("quality") == 1 - F.col("toxic")).cast("int")), 6).alias("agreement"), F.count("*").alias("pairs"))


@query("""
SELECT coalesce(nullif(event_type, 'signup'), '?') AS model, count(*) AS calls, CAST(sum(CASE WHEN event_id % 3 = 0 THEN k WHEN event_id % 3 = 1 THEN k + 1 ELSE 0 END) AS BIGINT) AS prompt, CAST(sum(k) AS BIGINT) AS output
FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events) GROUP BY 1
""")
def usage_by_model(t):
    k = F.get_json_object("props", "$.k").cast("bigint")
    # a third of the documents has the one key, a third the other, a third none
    document = F.to_json(F.struct(F.when(F.col("event_id") % 3 == 0, k).alias("prompt_tokens"), F.when(F.col("event_id") % 3 < 2, k + 1).alias("input_tokens")))
    e = t("events").select(F.nullif("event_type", F.lit("signup")).alias("model"), k.alias("k"), document.alias("document"))
    return e.groupBy(F.coalesce("model", F.lit("?")).alias("model")).agg(F.count("*").alias("calls"), F.sum(aggregates.usage_tokens(F.col("document"))).alias("prompt"), F.sum("k").alias("output"))


@query("SELECT round(sum(l_quantity * p_retailprice) / 1000000, 2) AS spend FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 10")
def estimated_spend(t):
    p = t("part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return t("lineitem").select("l_partkey", "l_quantity").join(p, "l_partkey").agg(F.round(F.sum(F.col("l_quantity") * F.col("p_retailprice")) / 1000000, 2).alias("spend"))


@query("SELECT o_orderstatus || CASE WHEN o_orderstatus = 'P' THEN '/' || o_orderpriority ELSE '' END AS state, count(*) AS n FROM orders GROUP BY 1")
def engine_states(t):
    reason = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise("")
    return t("orders").groupBy(aggregates.state_key(F.col("o_orderstatus"), reason).alias("state")).agg(F.count("*").alias("n"))


@query("""
SELECT count(*) AS turns, count(*) FILTER (WHERE event_type = 'error') AS errors, count(DISTINCT user_id) AS users, round(coalesce(sum(value), 0) / 1e9::DOUBLE, 12) AS spend, count(*) FILTER (WHERE value IS NULL) AS unknown, max(event_id) AS last FROM events
""")
def health_counters(t):
    return t("events").agg(F.count("*").alias("turns"), F.count_if(F.col("event_type") == "error").alias("errors"), F.countDistinct("user_id").alias("users"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)) / 1e9, 12).alias("spend"), F.count_if(F.col("value").isNull()).alias("unknown"), F.max("event_id").alias("last"))


@query("""
SELECT CASE WHEN k IS NULL OR k = '' THEN 'submission_failed' ELSE k END AS code, count(*) AS n, min(ts) AS first_at FROM (SELECT CASE WHEN event_id % 10 = 0 THEN '' WHEN event_id % 10 = 1 THEN NULL ELSE 'e' || (props->>'$.k') END AS k, ts FROM events WHERE event_type = 'error') GROUP BY 1
""")
def error_codes_first_seen(t):
    e = t("events").where("event_type = 'error'")
    code = F.when(F.col("event_id") % 10 == 0, "").when(F.col("event_id") % 10 != 1, F.concat(F.lit("e"), F.get_json_object("props", "$.k")))
    return aggregates.error_codes(e, code, "ts")


@query("SELECT l_returnflag, m AS field, count(*) AS n FROM (SELECT l_returnflag, unnest([l_linestatus, CASE WHEN l_discount > 0.05::DOUBLE THEN 'discount' ELSE 'full' END]) AS m FROM lineitem) GROUP BY 1, 2")
def modified_fields(t):
    d = F.array("l_linestatus", F.when(F.col("l_discount") > 0.05, "discount").otherwise("full"))
    return t("lineitem").select("l_returnflag", F.explode(d).alias("field")).groupBy("l_returnflag", "field").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN n_chars < 200 THEN 'short' WHEN n_chars > 5000 THEN 'long' END AS reason, count(*) AS n FROM documents WHERE n_chars < 200 OR n_chars > 5000 GROUP BY 1")
def exclusions_by_reason(t):
    return t("documents").select(F.when(F.col("n_chars") < 200, "short").when(F.col("n_chars") > 5000, "long").alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


@query("""
SELECT CASE WHEN k % 4 > 0 THEN 'c' || k % 4 ELSE 'unknown' END AS code, count(*) AS n FROM (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events) WHERE event_type = 'error' AND event_id % 3 > 0 GROUP BY 1
""")
def faults_by_code(t):
    k = F.get_json_object("props", "$.k").cast("int") % 4
    detail = F.to_json(F.struct(F.when(k > 0, F.concat(F.lit("c"), k.cast("string"))).alias("code")))
    # an underscore is a wildcard unless it is escaped: the stage of every third event only looks alike
    stage = F.concat(F.when(F.col("event_id") % 3 == 0, "collectionXtrialX").otherwise("collection_trial_"), F.col("event_id").cast("string"))
    e = t("events").where("event_type = 'error'").select(stage.alias("stage"), detail.alias("detail")).where(F.col("stage").like("collection\\_trial\\_%"))
    return e.groupBy(F.coalesce(F.get_json_object("detail", "$.code"), F.lit("unknown")).alias("code")).agg(F.count("*").alias("n"))


@query("""
SELECT lang, count(DISTINCT source) AS sources, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars, count(DISTINCT md5(text)) AS texts, count(*) FILTER (WHERE n_chars > 2400) AS long FROM documents GROUP BY 1
""")
def coverage_ledger(t):
    # one digest a row travels instead of the text
    d = t("documents").select("lang", "source", "n_chars", F.md5("text").alias("h"))
    return d.groupBy("lang").agg(F.countDistinct("source").alias("sources"), F.count("*").alias("documents"), F.sum("n_chars").alias("chars"), F.countDistinct("h").alias("texts"), F.count_if(F.col("n_chars") > 2400).alias("long"))


@query("""
WITH r AS (SELECT lang, n_chars AS v, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT lang, max(n) AS n, CAST(sum(v) AS BIGINT) AS total, min(v) AS least, min(v) FILTER (WHERE i = least(n - 1, CAST(floor(0.5::DOUBLE * n) AS BIGINT))) AS p50, min(v) FILTER (WHERE i = least(n - 1, CAST(floor(0.9::DOUBLE * n) AS BIGINT))) AS p90, max(v) AS most FROM r GROUP BY lang
""")
def token_distribution(t):
    return stats.at_share(t("documents").select("lang", "n_chars"), ["lang"], "n_chars", {"p50": 0.5, "p90": 0.9})


@query("""
WITH cells AS (SELECT r_name, s.s AS status FROM region, (VALUES ('F'), ('O'), ('P')) s(s)), have AS (SELECT r_name, o_orderstatus AS status, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice > 450000 GROUP BY 1, 2)
SELECT c.r_name, c.status, 60 AS need, coalesce(h.n, 0) AS n, 60 - coalesce(h.n, 0) AS missing FROM cells c LEFT JOIN have h ON c.r_name = h.r_name AND c.status = h.status WHERE coalesce(h.n, 0) < 60
""")
def coverage_deficits(t):
    o = t("orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status"))
    geo = t("nation").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    have = o.join(t("customer").select("c_custkey", "c_nationkey"), "c_custkey").join(geo, "c_nationkey").groupBy("r_name", "status").agg(F.count("*").alias("n"))
    cells = t("region").select("r_name", F.explode(F.array(F.lit("F"), F.lit("O"), F.lit("P"))).alias("status"), F.lit(60).alias("need"))
    return aggregates.deficits(cells, have, ["r_name", "status"])


@query("""
SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS pairs, round(sum(d * n) / sum(n), 4) AS d, round(sum(x * n) / sum(n), 4) AS x FROM (SELECT l_returnflag, l_suppkey, count(*) AS n, avg(l_discount) AS d, avg(l_tax) AS x FROM lineitem GROUP BY 1, 2) GROUP BY 1
""")
def rerank_pooled(t):
    per = t("lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("n"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("x"))
    return aggregates.pooled(per, ["l_returnflag"], "n", ["d", "x"])


@query("""
WITH a AS (SELECT o_custkey, list(DISTINCT o_orderpriority) AS given, list(DISTINCT o_orderpriority) FILTER (WHERE o_totalprice > 250000) AS used FROM orders GROUP BY 1)
SELECT round(sum(len(list_intersect(given, coalesce(used, []))))::DOUBLE / sum(len(given)), 6) AS fallback FROM a
""")
def fallback_precision(t):
    g = t("orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("given"), F.collect_set(F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority"))).alias("used"))
    return g.agg(F.round(F.sum(F.size(F.array_intersect("given", "used"))) / F.sum(F.size("given")), 6).alias("fallback"))


_WILSON = "WITH c AS (SELECT s_nationkey AS k, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS s FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1), w AS (SELECT k, n, s, s / n::DOUBLE AS p, 1.64485::DOUBLE AS z FROM c)"
_LOW = "greatest((p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n), 0)"


@query(f"{_WILSON} SELECT k, n, s, round({_LOW}, 6) AS low, round(least((p + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n), 1), 6) AS high FROM w")
def wilson_floor(t):
    j = t("lineitem").select("l_suppkey", "l_returnflag").join(t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("k")), "l_suppkey")
    c = j.groupBy("k").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("s"))
    low, high = stats.wilson(F.col("s"), F.col("n"))
    return c.select("k", "n", "s", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("""
WITH a AS (SELECT l_returnflag AS arm, l_suppkey % 25 AS task, avg(l_discount) AS m FROM lineitem GROUP BY 1, 2) SELECT arm, count(*) AS tasks, round(avg(m), 8) AS mean FROM a GROUP BY 1
""")
def paired_arm_means(t):
    a = t("lineitem").select(F.col("l_returnflag").alias("arm"), (F.col("l_suppkey") % 25).alias("task"), "l_discount")
    return aggregates.clustered_means(a, "arm", "task", "l_discount").withColumn("mean", F.round("mean", 8))


_BOOT = """
WITH m AS (SELECT l_suppkey % 25 AS task, avg(l_discount) FILTER (WHERE l_returnflag = 'R') - avg(l_discount) FILTER (WHERE l_returnflag = 'A') AS v FROM lineitem GROUP BY 1),
t AS (SELECT row_number() OVER (ORDER BY task) - 1 AS i, v FROM m WHERE v IS NOT NULL), n AS (SELECT count(*) AS n FROM t),
d AS (SELECT b, ('0x' || substr(sha256('7:' || CAST(b AS VARCHAR) || ':' || CAST(i AS VARCHAR)), 1, 12))::BIGINT % (SELECT n FROM n) AS i FROM range(0, 2000) r(b), t),
x AS (SELECT b, avg(v) AS m FROM d JOIN t ON d.i = t.i GROUP BY b), k AS (SELECT m, row_number() OVER (ORDER BY m, b) - 1 AS r FROM x)
SELECT round(max(m) FILTER (WHERE r = 50), 8) AS low, round(max(m) FILTER (WHERE r = 1950), 8) AS high, round((SELECT avg(v) FROM t), 8) AS mean, (SELECT n FROM n) AS tasks FROM k
"""


@query(_BOOT)
def bootstrap_interval(t):
    a = t("lineitem").select(F.col("l_returnflag").alias("arm"), (F.col("l_suppkey") % 25).alias("task"), "l_discount")
    d = aggregates.paired_differences(a, "arm", ("A", "R"), "task", "l_discount")
    out = aggregates.bootstrap_interval(d, "task", "difference", 2000, 0.95, 7)
    return out.select(*(F.round(c, 8).alias(c) for c in ("low", "high", "mean")), "tasks")


@query("""
SELECT l_orderkey, CASE max(CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END) WHEN 2 THEN 'failure' WHEN 1 THEN 'unknown' ELSE 'success' END AS outcome FROM lineitem GROUP BY 1
""")
def turn_outcome(t):
    o = t("lineitem").select("l_orderkey", F.when(F.col("l_returnflag") == "R", "failure").when(F.col("l_returnflag") == "A", "unknown").otherwise("success").alias("o"))
    return aggregates.turn_outcome(o, ["l_orderkey"], "o")


@query("SELECT o_custkey, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'pass' WHEN bool_or(o_orderstatus = 'F') THEN 'split' ELSE 'fail' END AS verdict FROM orders GROUP BY 1")
def review_verdicts(t):
    return aggregates.verdicts(t("orders").select("o_custkey", (F.col("o_orderstatus") == "F").alias("ok")), ["o_custkey"], "ok")


@query("""
WITH need AS (SELECT 'F' AS c UNION ALL SELECT 'O'), have AS (SELECT DISTINCT o_custkey, o_orderstatus AS c FROM orders), k AS (SELECT o_custkey, bool_and(o_totalprice < 480000) AS clean FROM orders GROUP BY 1)
SELECT k.o_custkey, k.clean AND (SELECT count(*) FROM need n WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.o_custkey = k.o_custkey AND h.c = n.c)) = 0 AS passed FROM k
""")
def episode_verdicts(t):
    g = t("orders").groupBy("o_custkey").agg(F.bool_and(F.col("o_totalprice") < 480000).alias("clean"), F.collect_set("o_orderstatus").alias("have"))
    return g.select("o_custkey", (F.col("clean") & (F.size(F.array_except(F.array(F.lit("F"), F.lit("O")), "have")) == 0)).alias("passed"))


@query("SELECT c_mktsegment AS partition, count(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1")
def collection_targets(t):
    return t("customer").where("c_mktsegment <> 'BUILDING'").groupBy(F.col("c_mktsegment").alias("partition")).agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders")
def queue_states(t):
    s = F.col("o_orderstatus")
    return t("orders").agg(F.count_if(s == "F").alias("f"), F.count_if(s == "O").alias("o"), F.count_if(s == "P").alias("p"))


@query("SELECT coalesce(CASE WHEN n_chars >= 200 THEN lang END, 'excluded:short') AS category, count(*) AS n FROM documents GROUP BY 1")
def export_counts(t):
    kept = F.when(F.col("n_chars") >= 200, F.col("lang"))
    return t("documents").groupBy(F.coalesce(kept, F.concat(F.lit("excluded:"), F.lit("short"))).alias("category")).agg(F.count("*").alias("n"))


@query("""
SELECT l_suppkey, l_returnflag AS focus, count(*) AS attempts, count(*) FILTER (WHERE l_linestatus = 'F') AS success FROM lineitem GROUP BY 1, 2
""")
def teacher_attempts(t):
    return t("lineitem").groupBy("l_suppkey", F.col("l_returnflag").alias("focus")).agg(F.count("*").alias("attempts"), F.count_if(F.col("l_linestatus") == "F").alias("success"))


@query("""
SELECT count(*) FILTER (WHERE bad) AS families FROM (SELECT o_custkey, bool_or(o_orderstatus = 'P' AND o_totalprice > 400000) AS bad FROM orders GROUP BY 1)
""")
def unsettled_families(t):
    bad = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)
    return t("orders").groupBy("o_custkey").agg(F.bool_or(bad).alias("bad")).agg(F.count_if("bad").alias("families"))


@query("""
WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_type <> 'view' THEN value END AS v FROM events)
SELECT user_id, min(ts) AS first_at, arg_max(v, ts) FILTER (WHERE v IS NOT NULL) AS v FROM e GROUP BY 1
""")
def merged_observations(t):
    e = t("events").select("user_id", "ts", F.when(F.col("event_type") != "view", F.col("value")).alias("v"))
    return aggregates.merged_observations(e, "user_id", "ts", ["v"])


@query("""
WITH k AS (SELECT user_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events),
e AS (SELECT user_id, k % 3 AS session, k % 11 AS kind FROM k)
SELECT user_id, count(*) FILTER (WHERE kind NOT IN (0, 1, 2, 3, 4)) AS unauthorized, abs(count(*) - 60) + count(*) FILTER (WHERE session = 2) AS interventions FROM e GROUP BY 1
""")
def unauthorized_effects(t):
    # the first five stay under an allowed root; the rest leave the project or the roots, or only share their first letters
    paths = ("a/x", "/work/p/b/c/y", "./a//z", "a", "/work/p/./b/c", "ab/x", "a/../b/c/x", "/work/pa/a/x", "/etc/a", "b/cc", "b")
    k = F.get_json_object("props", "$.k").cast("int")
    e = t("events").select("user_id", (k % 3).alias("session"), F.element_at(F.array(*map(F.lit, paths)), k % 11 + 1).alias("path"), F.lit("/work/p").alias("project"), F.array(F.lit("a"), F.lit("b/c/")).alias("roots"))
    users = t("events").groupBy("user_id").agg(F.count("*").alias("made"), F.lit(60).alias("expected"))
    sessions = users.select("user_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("session"))
    return filters.effect_receipt(e, sessions, users, "user_id")


@query("SELECT o_custkey, CAST(60 * (1.5::DOUBLE * count(*) * 60 + 30) AS BIGINT) AS seconds FROM orders GROUP BY 1")
def shard_deadlines(t):
    return t("orders").groupBy("o_custkey").agg((60 * (F.lit(1.5) * F.count("*") * 60 + 30)).cast("bigint").alias("seconds"))


@query("""
SELECT r_name, CASE WHEN n < 300 THEN ['orders'] ELSE [] END AS failures, n >= 300 AS publish FROM (SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
""")
def publish_decisions(t):
    geo = t("nation").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    n = t("customer").join(geo, "c_nationkey").groupBy("r_name").agg(F.count("*").alias("n"))
    failures = F.array_compact(F.array(F.when(F.col("n") < 300, "orders")))
    return n.select("r_name", failures.alias("failures"), (F.size(failures) == 0).alias("publish"))


@query("SELECT round(sum(value), 2) <= 600000 AS within_ceiling FROM events")
def spend_ceiling(t):
    return t("events").agg(F.coalesce(F.round(F.sum("value"), 2) <= 600000, F.lit(True)).alias("within_ceiling"))
