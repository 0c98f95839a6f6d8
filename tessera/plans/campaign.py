"""Admission, quotas, ledgers, schemas and the frames that other queries leave out."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.schema import first_error
from ..operators import aggregates, campaign, joins, validation
from ..operators.windows import first_per
from .counts import _SPLIT_SQL, with_split
from .registry import position_sql, query

SCHEMA = {
    "type": "object",
    "required": ["event_type", "k"],
    "additionalProperties": False,
    "properties": {"event_type": {"enum": ["click", "view", "purchase", "error"]}, "value": {"type": "number", "maximum": 100}, "k": {"type": "integer", "minimum": 10, "maximum": 90}},
}


@query("""
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '$: required k' WHEN event_id % 11 = 0 THEN '$: additionalProperties' WHEN event_type = 'signup' THEN '$.event_type: enum'
  WHEN value > 100 THEN '$.value: maximum' WHEN k < 10 THEN '$.k: minimum' WHEN k > 90 THEN '$.k: maximum' END AS error FROM (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events)
""")
def schema_first_error(t):
    k = F.when(F.col("event_id") % 7 > 0, F.get_json_object("props", "$.k").cast("int"))
    document = F.to_json(F.struct("event_type", "value", k.alias("k"), F.when(F.col("event_id") % 11 == 0, 1).alias("extra")))
    return t("events").select("event_id", F.try_parse_json(document).alias("v")).select("event_id", first_error(F.col("v"), SCHEMA).alias("error"))


@query("""
WITH o AS (SELECT user_id, ts, CASE WHEN event_type = 'view' THEN 'r' || CAST(props->>'$.k' AS INTEGER) % 4 END AS rev, CASE WHEN value < 30 THEN 'passed' END AS verdict FROM events WHERE event_type IN ('view', 'click')),
j AS (SELECT m.event_id, o.ts, o.rev, o.verdict FROM events m LEFT JOIN o ON m.user_id = o.user_id AND o.ts <= m.ts WHERE m.event_type = 'purchase')
SELECT event_id, count(*) FILTER (WHERE verdict = 'passed') > 0 AND count(rev) > 0 AND NOT list_contains(coalesce(list(rev) FILTER (WHERE verdict = 'passed' AND rev IS NOT NULL), []), arg_max(rev, ts) FILTER (WHERE rev IS NOT NULL)) AS stale FROM j GROUP BY 1
""")
def stale_verifications(t):
    e = t("events")
    k = F.get_json_object("props", "$.k").cast("int") % 4
    o = e.where("event_type in ('view', 'click')").select("user_id", F.col("ts").alias("started_at"), F.col("event_id").alias("order"), F.when(F.col("event_type") == "view", F.concat(F.lit("r"), k.cast("string"))).alias("source_revision"), F.when(F.col("value") < 30, "passed").alias("source_verdict"))
    m = e.where("event_type = 'purchase'").select("user_id", "event_id", F.col("ts").alias("at"))
    return campaign.stale_verifications(m, o, "user_id", "event_id")


_ADMISSION = """
WITH t AS (SELECT o_custkey AS episode, o_custkey * 2 + o_orderkey % 2 AS session, o_orderkey AS turn, o_orderdate AS moment, o_totalprice < 400000 AS committed, CASE WHEN o_orderkey % 13 = 0 THEN 'x' END AS host, CASE WHEN o_orderkey % 17 = 0 THEN 'uncited_closeout' END AS closing FROM orders),
l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem),
c AS (SELECT l_orderkey AS turn, l_linenumber * 1000000 + l_partkey AS pos, CASE WHEN l_partkey % 50 = 0 THEN 'unoffered_call' WHEN l_partkey % 51 = 0 THEN 'unrecorded_call' WHEN l_quantity = 50 THEN 'unsettled_operation' WHEN l_discount = 0 THEN 'unknown_effects'
  WHEN l_partkey % 53 = 0 THEN 'replay_after_unknown_effects' WHEN l_partkey % 7 = 0 AND l_returnflag = 'R' AND l_linenumber = 1 THEN 'authorization_refusal' END AS why,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 2 WHEN l_tax = 0 AND l_linenumber = 2 THEN 1 ELSE 0 END AS worst, l_linestatus = 'F' AS failing, 'r' || l_suppkey % 3 AS rev FROM l WHERE l_orderkey % 4 <> 0),
o AS (SELECT o_custkey AS episode, l_shipdate AS moment, l_orderkey * 10 + l_linenumber AS ord, CASE WHEN l_partkey % 3 > 0 THEN 'r' || l_suppkey % 3 END AS rev, l_linestatus = 'O' AS passed FROM l JOIN orders ON l_orderkey = o_orderkey),
init AS (SELECT episode, rev AS initial FROM (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY moment, ord) AS r FROM o WHERE rev IS NOT NULL) WHERE r = 1),
per AS (SELECT c.turn, arg_min(why, pos) FILTER (WHERE why IS NOT NULL) AS why, max(worst) AS worst, bool_or(coalesce(failing AND c.rev = initial, false)) AS reproduced FROM c JOIN t ON c.turn = t.turn LEFT JOIN init ON init.episode = t.episode GROUP BY 1),
last AS (SELECT turn, rev FROM (SELECT t.turn, o.rev, row_number() OVER (PARTITION BY t.turn ORDER BY o.moment DESC, o.ord DESC) AS r FROM t JOIN o ON t.episode = o.episode AND o.moment <= t.moment WHERE o.rev IS NOT NULL) WHERE r = 1),
st AS (SELECT t.turn, count(*) > 0 AND max(last.rev) IS NOT NULL AND NOT bool_or(coalesce(o.rev = last.rev, false)) AS stale FROM t JOIN o ON t.episode = o.episode AND o.moment <= t.moment AND o.passed LEFT JOIN last ON last.turn = t.turn GROUP BY 1),
x AS (SELECT t.*, per.why, per.worst, per.reproduced, coalesce(stale, false) AS stale, t.episode % 2 = 0 AS witness, CASE WHEN host IS NULL THEN CASE coalesce(worst, 0) WHEN 2 THEN 'failure' WHEN 1 THEN 'unknown' ELSE 'success' END END AS outcome FROM t LEFT JOIN per ON per.turn = t.turn LEFT JOIN st ON st.turn = t.turn),
f AS (SELECT *, coalesce(bool_or(outcome = 'failure') OVER (PARTITION BY episode, session ORDER BY moment, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS earlier FROM x),
r AS (SELECT *, CASE WHEN host IS NOT NULL THEN 'host_excluded' WHEN worst IS NOT NULL AND why IS NOT NULL THEN why WHEN worst IS NOT NULL AND outcome = 'failure' AND NOT (witness AND reproduced) THEN 'failure_without_witness'
  WHEN worst IS NOT NULL AND outcome = 'unknown' THEN 'unknown_outcome' WHEN worst IS NULL AND NOT committed THEN 'uncommitted_reply' WHEN worst IS NULL AND closing IS NOT NULL THEN closing WHEN worst IS NULL AND stale THEN 'stale_verification' END AS reason FROM f)
SELECT episode, session, turn, CASE WHEN reason IS NULL THEN 'eligible' ELSE 'excluded' END AS eligibility, CASE WHEN reason IS NULL THEN CASE WHEN worst IS NULL THEN 'closeout' WHEN outcome = 'failure' THEN 'diagnostic' WHEN earlier THEN 'recovery' ELSE 'ordinary' END END AS category, reason, outcome FROM r
"""


@query(_ADMISSION)
def admission_sequence(t):
    o, c = t("orders"), F.col
    turns = o.select(c("o_custkey").alias("episode"), (c("o_custkey") * 2 + c("o_orderkey") % 2).alias("session"), c("o_orderkey").alias("turn"), c("o_orderdate").alias("settled_at"), (c("o_totalprice") < 400000).alias("committed"), F.when(c("o_orderkey") % 13 == 0, "x").alias("host_exclusion"), F.when(c("o_orderkey") % 17 == 0, "uncited_closeout").alias("closeout_reason"))
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").distinct()
    outcome = F.when((c("l_returnflag") == "R") & (c("l_linenumber") == 1), "failure").when((c("l_tax") == 0) & (c("l_linenumber") == 2), "unknown").otherwise("success")
    revision = F.concat(F.lit("r"), (c("l_suppkey") % 3).cast("string"))
    calls = lines.where("l_orderkey % 4 <> 0").select(
        c("l_orderkey").alias("turn"), (c("l_linenumber") * 1000000 + c("l_partkey")).alias("position"), (c("l_partkey") % 50 > 0).alias("offered"), (c("l_partkey") % 51 > 0).alias("recorded"), F.when(c("l_quantity") == 50, "open").otherwise("settled").alias("settlement"),
        F.when(c("l_discount") == 0, "unknown").otherwise("known").alias("effect_state"), (c("l_partkey") % 53 == 0).alias("replays_unknown_effects"), (c("l_partkey") % 7 > 0).alias("invoked"), outcome.alias("semantic_outcome"), F.when(c("l_linestatus") == "F", "failed").otherwise("passed").alias("source_verdict"), revision.alias("source_revision"),
    )
    operations = lines.join(o.select(c("o_orderkey").alias("l_orderkey"), c("o_custkey").alias("episode")), "l_orderkey").select("episode", c("l_shipdate").alias("started_at"), (c("l_orderkey") * 10 + c("l_linenumber")).cast("long").alias("order"), F.when(c("l_partkey") % 3 > 0, revision).alias("source_revision"), F.when(c("l_linestatus") == "F", "failed").otherwise("passed").alias("source_verdict"))
    return campaign.admission(turns, calls, operations, t("customer").where("c_custkey % 2 = 0").select(c("c_custkey").alias("episode")))


@query("""
SELECT l_orderkey, CASE WHEN bool_or(bad = 1) THEN arg_min(why, l_linenumber) FILTER (WHERE bad = 1) END AS reason FROM (SELECT DISTINCT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 AND l_orderkey % 2 = 0 THEN 'third' WHEN l_linenumber = 5 THEN 'fifth' END AS why,
  CASE WHEN (l_linenumber % 3 = 0 AND l_orderkey % 2 = 0) OR l_linenumber = 5 THEN 1 ELSE 0 END AS bad FROM lineitem) GROUP BY 1
""")
def first_reason_in_array(t):
    calls = t("lineitem").select("l_orderkey", "l_linenumber").distinct().groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("calls"))
    reason = lambda n: F.when((n % 3 == 0) & (F.col("l_orderkey") % 2 == 0), "third").when(n == 5, "fifth")
    return calls.select("l_orderkey", campaign.first_reason_of(F.col("calls"), reason).alias("reason"))


@query("""
WITH a AS (SELECT o_orderstatus AS partition, o_orderkey AS place, o_orderkey AS task, 'f' || o_orderkey % 3 AS focus, o_custkey % 40 AS grp, i AS attempt, (o_orderkey * 7 + i * 3) % 5 = 0 AS success FROM orders, range(0, 5) r(i)),
w AS (SELECT partition, place, task, focus, grp, min(attempt) FILTER (WHERE success) AS won FROM a WHERE attempt < 3 GROUP BY ALL),
n AS (SELECT *, CASE WHEN won IS NOT NULL AND row_number() OVER (PARTITION BY partition, focus, grp, won IS NULL ORDER BY place) = 1 THEN 1 ELSE 0 END AS new FROM w),
s AS (SELECT *, coalesce(sum(CASE WHEN won IS NOT NULL THEN 1 ELSE 0 END) OVER b, 0) AS have, coalesce(sum(CASE WHEN focus = 'f0' THEN new END) OVER b, 0) AS g0, coalesce(sum(CASE WHEN focus = 'f1' THEN new END) OVER b, 0) AS g1, coalesce(sum(CASE WHEN focus = 'f2' THEN new END) OVER b, 0) AS g2
  FROM n WINDOW b AS (PARTITION BY partition ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT a.partition, a.place, a.task, a.focus, a.grp, a.attempt, coalesce(a.attempt = s.won, false) AS admitted FROM a JOIN s ON a.partition = s.partition AND a.task = s.task
WHERE a.attempt < 3 AND a.attempt <= coalesce(s.won, 2) AND NOT (have >= 40 AND g0 >= 9 AND g1 >= 9 AND g2 >= 9)
""")
def quota_collection(t):
    a = t("orders").withColumn("attempt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))))
    a = a.select(F.col("o_orderstatus").alias("partition"), F.col("o_orderkey").alias("place"), F.col("o_orderkey").alias("task"), F.concat(F.lit("f"), (F.col("o_orderkey") % 3).cast("string")).alias("focus"), (F.col("o_custkey") % 40).alias("grp"), "attempt", ((F.col("o_orderkey") * 7 + F.col("attempt") * 3) % 5 == 0).alias("success"))
    return campaign.quota_collection(a, 40, 9, ["f0", "f1", "f2"])


@query("""
WITH s AS (SELECT s_suppkey AS k, s_name AS student, s_suppkey % 3 > 0 AS publish FROM supplier), b(bundle) AS (VALUES ('full'), ('small')),
pub AS (SELECT k, student, bundle, CASE WHEN k % 7 = 0 THEN 'other' ELSE 'm' || k || bundle END AS made FROM s, b WHERE k % 4 > 0 AND NOT (k % 5 = 0 AND bundle = 'small') UNION ALL SELECT k, student, 'strange', 'm' FROM s WHERE k % 11 = 0)
SELECT s.student, CASE WHEN publish AND (count(p.bundle) FILTER (WHERE p.bundle IN ('full', 'small')) < 2 OR count(p.bundle) FILTER (WHERE p.bundle = 'strange') > 0) THEN 'publication_incomplete'
  WHEN publish AND bool_or(p.made <> 'm' || s.k || p.bundle) THEN 'publication_not_probed' WHEN NOT publish AND count(p.bundle) > 0 THEN 'publication_not_decided' END AS fault
FROM s LEFT JOIN pub p ON s.student = p.student GROUP BY s.student, publish HAVING fault IS NOT NULL
""")
def ledger_faults(t):
    s = t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("student"), (F.col("s_suppkey") % 3 > 0).alias("publish"))
    each = s.withColumn("bundle", F.explode(F.array(F.lit("full"), F.lit("small"))))
    manifest = F.concat(F.lit("m"), F.col("k").cast("string"), F.col("bundle"))
    made = each.where("k % 4 > 0 and not (k % 5 = 0 and bundle = 'small')").select("student", "bundle", F.when(F.col("k") % 7 == 0, "other").otherwise(manifest).alias("manifest_sha256"))
    made = made.unionByName(s.where("k % 11 = 0").select("student", F.lit("strange").alias("bundle"), F.lit("m").alias("manifest_sha256")))
    return campaign.ledger_faults(s.select("student", "publish"), each.select("student", "bundle", manifest.alias("manifest_sha256")), made, ["full", "small"])


@query("""
SELECT p_partkey AS id, CAST(least(greatest(1, CASE WHEN p_size * 0.3::DOUBLE - floor(p_size * 0.3::DOUBLE) = 0.5 THEN CASE WHEN floor(p_size * 0.3::DOUBLE) % 2 = 0 THEN floor(p_size * 0.3::DOUBLE) ELSE ceil(p_size * 0.3::DOUBLE) END ELSE round(p_size * 0.3::DOUBLE) END), 12) AS INTEGER) AS per_workspace,
  0.25::DOUBLE AS follow_up_rate, 2 AS max_follow_ups FROM part
""")
def scaled_archetypes(t):
    a = t("part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("per_workspace"), F.lit(0.5).alias("follow_up_rate"), F.lit(5).alias("max_follow_ups"))
    return campaign.scaled(a, share=0.3, cap=12, follow_up_rate=0.25, follow_ups=2)


@query("""
SELECT 'family:' || substr(sha256(s || chr(10) || k || chr(10) || CAST(i AS VARCHAR)), 1, 16) AS node, 'w' || i AS workspace FROM (SELECT DISTINCT p_type AS s FROM part), (VALUES ('direct'), ('oblique')) v(k), unnest(range(0, 3)) u(i)
UNION ALL SELECT 'family:' || substr(sha256('none' || chr(10) || 'none' || chr(10) || CAST(i AS VARCHAR)), 1, 16), 'w' || i FROM unnest(range(0, 5)) u(i)
""")
def family_nodes(t):
    from .lookups import family_product

    return family_product(t).select(F.concat(F.lit("family:"), F.col("family")).alias("node"), F.concat(F.lit("w"), F.col("idx").cast("string")).alias("workspace"))


@query("""
SELECT a.event_id, b.event_id AS span FROM events a JOIN events b ON a.user_id = b.user_id AND a.value >= b.value - 10 AND a.value < b.value + 25 WHERE a.event_type = 'view' AND b.event_type = 'purchase'
""")
def interval_join(t):
    e = t("events")
    spans = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("span"), (F.col("value") - 10).alias("low"), (F.col("value") + 25).alias("high"))
    return joins.interval_join(e.where("event_type = 'view'").select("user_id", "event_id", "value"), spans, ["user_id"], "value", "low", "high", 35).select("event_id", "span")


@query("""
SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())
""")
def grouping_sets(t):
    f, s, n = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    return t("lineitem").groupingSets([[f, s], [n], []], f, s, n).agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, true AS parts_close, true AS median_close FROM lineitem GROUP BY 1")
def approximate_within_bounds(t):
    """Sketches against exact values: within five standard errors, and between the quantiles around the median."""
    g = t("lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("a"), F.countDistinct("l_partkey").alias("n"), F.percentile_approx("l_quantity", 0.5, 1000).alias("m"), F.percentile("l_quantity", F.array(F.lit(0.49), F.lit(0.51))).alias("q"))
    return g.select("l_returnflag", (F.abs(F.col("a") - F.col("n")) <= 0.1 * F.col("n")).alias("parts_close"), F.col("m").between(F.col("q")[0], F.col("q")[1]).alias("median_close"))


@query("""
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY k RANGE BETWEEN 5 PRECEDING AND CURRENT ROW), 4) AS near, count(*) OVER (PARTITION BY user_id ORDER BY k GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS groups
FROM (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events)
""")
def range_and_groups_frames(t):
    # a frame of groups is a frame of ranges over the groups' dense ranks
    e = t("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    e = e.withColumn("g", F.dense_rank().over(W.partitionBy("user_id").orderBy("k")))
    near = F.sum("value").over(W.partitionBy("user_id").orderBy("k").rangeBetween(-5, 0))
    return e.select("event_id", F.round(near, 4).alias("near"), F.count("*").over(W.partitionBy("user_id").orderBy("g").rangeBetween(-1, 1)).alias("groups"))


@query("""
SELECT start, event_type, count(*) AS n FROM (SELECT event_type, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start FROM events) GROUP BY 1, 2
""")
def sliding_windows(t):
    w = F.window("ts", "2 hours", "1 hour")
    return t("events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, -o_totalprice, o_orderkey) AS place FROM orders QUALIFY place <= 200
""")
def items_by_kind_rank(t):
    rank = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    top = t("orders").select("o_orderkey", rank.alias("kind"), "o_totalprice").orderBy("kind", F.col("o_totalprice").desc(), "o_orderkey").limit(200)
    # the limit is the report's; only its rows are numbered
    return top.withColumn("place", F.row_number().over(W.orderBy("kind", F.col("o_totalprice").desc(), "o_orderkey"))).select("o_orderkey", "place")


@query("""
WITH p AS (SELECT l_returnflag, round(sum(d * n) / sum(n), 4) AS lexical, round(sum(x * n) / sum(n), 4) AS blended FROM (SELECT l_returnflag, l_suppkey, count(*) AS n, avg(l_discount) AS d, avg(l_tax) AS x FROM lineitem GROUP BY 1, 2) GROUP BY 1)
SELECT l_returnflag, lexical, blended, round(blended - lexical, 4) AS gain FROM p
""")
def pooled_gain(t):
    per = t("lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("n"), F.avg("l_discount").alias("lexical"), F.avg("l_tax").alias("blended"))
    out = aggregates.pooled(per, ["l_returnflag"], "n", ["lexical", "blended"])
    return out.select("l_returnflag", "lexical", "blended", F.round(F.col("blended") - F.col("lexical"), 4).alias("gain"))


@query("""
WITH p AS (SELECT l_suppkey AS student, l_returnflag AS bundle, l_partkey * 10 + l_linenumber AS probe, CASE WHEN l_quantity < 30 THEN 'export_unbound' WHEN l_discount > 0.05::DOUBLE THEN 'device' END AS fault FROM lineitem)
SELECT student, bundle, min(probe) FILTER (WHERE fault IS NULL) AS qualifying, CASE WHEN count(*) FILTER (WHERE fault IS NULL) = 0 THEN 'load_probe_' || bundle || '_' || min(fault) END AS failure FROM p GROUP BY 1, 2
""")
def qualifying_probes(t):
    fault = F.when(F.col("l_quantity") < 30, "export_unbound").when(F.col("l_discount") > 0.05, "device")
    p = t("lineitem").select(F.col("l_suppkey").alias("student"), F.col("l_returnflag").alias("bundle"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("probe"), fault.alias("fault"))
    first = first_per(p.where("fault is null"), ["student", "bundle"], [F.col("probe")]).select("student", "bundle", F.col("probe").alias("qualifying"))
    every = p.groupBy("student", "bundle").agg(F.min("fault").alias("why")).join(first, ["student", "bundle"], "left")
    return every.select("student", "bundle", "qualifying", F.when(F.col("qualifying").isNull(), F.concat_ws("_", F.lit("load_probe"), "bundle", "why")).alias("failure"))


@query("""
WITH e AS (SELECT o_custkey, o_orderkey, o_orderpriority FROM orders), x AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 0)
SELECT o_orderkey, CASE WHEN x.c_custkey IS NULL THEN 'source_unknown' WHEN l.n IS NULL THEN 'row_not_exported' WHEN o_orderpriority = '5-LOW' AND x.c_nationkey % 5 = 0 THEN 'lineage_differs' END AS issue
FROM e LEFT JOIN x ON e.o_custkey = x.c_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) l ON l.l_orderkey = e.o_orderkey WHERE issue IS NOT NULL
""")
def source_issues(t):
    c = F.col
    sources = t("customer").where("c_acctbal > 0").select(c("c_custkey").alias("source"), F.concat(F.lit("line-"), F.when(c("c_nationkey") % 5 == 0, "new").otherwise("old")).alias("lineage"))
    rows = t("orders").select(c("o_orderkey").alias("row"), c("o_custkey").alias("source"), F.when(c("o_orderpriority") == "5-LOW", F.lit("line-old")).alias("stated"))
    exported = t("lineitem").where("l_linestatus = 'O'").select(c("l_orderkey").alias("row"))
    return validation.source_issues(rows, sources, exported).select(c("row").alias("o_orderkey"), "issue")


@query("""
WITH r AS (SELECT o_orderkey // 4 AS id, o_custkey AS session, o_orderpriority AS task, o_clerkless AS frozen FROM (SELECT *, o_totalprice < 420000 AS o_clerkless FROM orders))
SELECT 'repeated_id' AS violation, CAST(id AS VARCHAR) AS subject FROM r GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'session_of_many_tasks', CAST(session AS VARCHAR) FROM r GROUP BY session HAVING count(DISTINCT task) > 1
UNION ALL SELECT 'unfrozen_bank', CAST(id AS VARCHAR) FROM r WHERE NOT frozen
""")
def registration_violations(t):
    r = t("orders").select(F.expr("o_orderkey div 4").alias("id"), F.col("o_custkey").alias("session"), F.col("o_orderpriority").alias("task"), (F.col("o_totalprice") < 420000).alias("frozen"))
    return validation.registration(r)


@query(f"""
WITH d AS (SELECT *, {_SPLIT_SQL} AS split, CASE WHEN source = 'src1' THEN 'system_test' ELSE {_SPLIT_SQL} END AS expected, md5(text) AS h FROM documents)
SELECT 'schema' AS "check", (SELECT count(*) FROM d WHERE NOT coalesce(n_chars >= 50 AND lang IN ('en', 'de', 'fr', 'es'), false)) AS violations
UNION ALL SELECT 'meta', (SELECT count(*) FROM d WHERE source IS NULL OR lang IS NULL)
UNION ALL SELECT 'stats', (SELECT count(*) FROM (SELECT split, count(*) AS n FROM d GROUP BY 1) WHERE n % 2 = 1)
UNION ALL SELECT 'groups', (SELECT count(*) FROM (SELECT h FROM d GROUP BY h HAVING count(DISTINCT split) > 1))
UNION ALL SELECT 'holdout', (SELECT count(*) FROM d WHERE (source IN ('src1', 'src2')) <> (split = 'system_test'))
UNION ALL SELECT 'ancestry', (SELECT count(*) FROM d WHERE split <> expected)
UNION ALL SELECT 'tasks', (SELECT count(DISTINCT doc_id) FROM d WHERE doc_id NOT IN (SELECT doc_id FROM labels))
UNION ALL SELECT 'agreement', (SELECT CAST(count(*) = 0 AS BIGINT) FROM labels)
""")
def full_release_audit(t):
    d = with_split(t("documents").withColumn("h", F.md5("text"))).select("doc_id", "source", "lang", "n_chars", "h", "split")
    claims = d.groupBy(F.col("split").alias("name")).agg(F.count("*").alias("n")).select("name", (F.col("n") - F.col("n") % 2).alias("value"))
    held = F.col("source").isin("src1", "src2")
    expected = F.when(F.col("source") == "src1", "system_test").otherwise(F.col("split"))
    return validation.release_audit({
        "schema": d.where(first_error(F.try_parse_json(F.to_json(F.struct("lang", "n_chars"))), {"required": ["lang", "n_chars"], "properties": {"lang": {"enum": ["en", "de", "fr", "es"]}, "n_chars": {"minimum": 50}}}).isNotNull()),
        "meta": validation.required_keys(d, ["doc_id"], ["source", "lang"]).select("doc_id").distinct(),
        "stats": validation.recounted(claims, d, "name", "value", "split"),
        "groups": validation.one_split(d, "h", "split"),
        "holdout": d.where(held != (F.col("split") == "system_test")),
        "ancestry": validation.wrong_partition(d, d.select("doc_id", expected.alias("partition")), "doc_id"),
        "tasks": validation.unlisted(d.select("doc_id"), t("labels"), "doc_id"),
        "agreement": t("labels").agg(F.count("*").alias("n")).where("n = 0"),
    })


@query(f"""
SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % 211 WHERE {position_sql('repo', 'b.item_id')} < 0.85::DOUBLE
""")
def repositories_of_partitions(t):
    """Documents of the repositories that the allocation put into train or validation; documents of unknown ones are dropped, not refused."""
    from ..functions.hashing import position
    from ..operators.graphs import by_fraction

    held = t("benchmark").select("item_id", by_fraction(position("repo", F.col("item_id")), {"train": 0.7, "validation": 0.15, "system_test": 0.15}).alias("partition"))
    wanted = held.where(F.col("partition").isin("train", "validation")).select("item_id")
    return t("documents").select("doc_id", (F.col("doc_id") % 211).alias("item_id")).join(wanted, "item_id").select("doc_id", "item_id")


@query("""
WITH f AS (SELECT l_orderkey AS task, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1)
SELECT o_custkey AS shard, CASE WHEN max(o_orderkey) % 2 = 0 THEN 90 * 60 ELSE CAST(60 * (1.5::DOUBLE * sum(1 + coalesce(n, 0)) * 45 + 30) AS BIGINT) END AS seconds FROM orders LEFT JOIN f ON task = o_orderkey GROUP BY 1
""")
def deadlines_with_follow_ups(t):
    from ..functions.text import duration_minutes

    ups = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").distinct().groupBy("o_orderkey").agg(F.collect_set("l_linenumber").alias("follow_ups"))
    tasks = t("orders").select("o_custkey", "o_orderkey").join(ups, "o_orderkey", "left")
    g = tasks.groupBy(F.col("o_custkey").alias("shard")).agg(F.sum(1 + F.coalesce(F.size("follow_ups"), F.lit(0))).alias("prompts"), F.when(F.max("o_orderkey") % 2 == 0, "90m").alias("timeout"))
    return g.select("shard", F.coalesce(60 * duration_minutes(F.col("timeout")), 60 * (F.lit(1.5) * F.col("prompts") * 45 + 30)).cast("bigint").alias("seconds"))


@query("""
SELECT n_name, sha256('{"catalog":"' || n_regionkey || '","host":"' || n_name || '"}') AS sha256 FROM nation
""")
def identity_bindings(t):
    return t("nation").select("n_name", F.sha2(F.to_json(F.struct(F.col("n_regionkey").cast("string").alias("catalog"), F.col("n_name").alias("host"))), 256).alias("sha256"))


@query("""
SELECT conv_id, turn, role, length(text) AS chars, turn % 2 = 0 AS kept FROM conversations
""")
def dotted_path_set(t):
    from ..functions.exact import set_field

    record = F.struct(F.col("role"), F.struct(F.length("text").cast("bigint").alias("chars"), F.lit(False).alias("kept")).alias("size"))
    out = t("conversations").select("conv_id", "turn", set_field(record, "size.kept", F.col("turn") % 2 == 0).alias("record"))
    return out.select("conv_id", "turn", "record.role", "record.size.chars", "record.size.kept")


@query()
def half_even_rounding(t):
    from ..functions.exact import half_even

    return t("lineitem").select("l_orderkey", "l_linenumber", half_even(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("rounded"))
