"""Scalar, array, map and JSON functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays, hashing, stats, text
from .registry import draw_sql, position_sql, query


@query("""
SELECT p_partkey, list_sort(list_distinct(list_concat(list_filter(string_split(lower(n), '_'), lambda x: length(x) >= 3), [lower(n)]))) AS tokens
FROM (SELECT p_partkey, replace(p_name, ' ', '_') || '_id' AS n FROM part)
""")
def identifier_tokens(t):
    n = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_id"))
    return t("part").select("p_partkey", F.array_sort(text.identifier_tokens(n)).alias("tokens"))


@query("SELECT page_id, split_part(url, '/', -1) AS base, regexp_extract(url, '^(.*)/[^/]*$', 1) AS dir FROM pages")
def path_parts(t):
    return t("pages").select("page_id", text.basename(F.col("url")).alias("base"), text.dirname(F.col("url")).alias("dir"))


@query("""
SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey * 60 WHEN n_nationkey % 3 = 1 THEN n_nationkey END AS minutes FROM nation
""")
def duration_minutes(t):
    d = F.concat(F.col("n_nationkey").cast("string"), F.element_at(F.array(F.lit("h"), F.lit("m"), F.lit("s")), (F.col("n_nationkey") % 3 + 1).cast("int")))
    return t("nation").select("n_nationkey", text.duration_minutes(d).alias("minutes"))


@query("""
SELECT event_id, 'type=' || event_type || ' of ' || CAST(user_id AS VARCHAR) || ' $other' AS line FROM events
""")
def template_filled(t):
    m = F.create_map(F.lit("type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    return t("events").select("event_id", text.filled(F.lit("type=$type of $user $other"), m).alias("line"))


@query("SELECT event_id, '{\"k\": ' || (props->>'$.k') || '}' AS document FROM events")
def first_json(t):
    fenced = F.concat(F.lit("```json\nanswer: "), F.col("props"), F.lit(" done\n```"))
    return t("events").select("event_id", text.first_json(text.unfenced(fenced)).alias("document"))


@query(f"SELECT doc_id, round({position_sql('alloc', 'doc_id')}, 9) AS place FROM documents")
def hash_position(t):
    return t("documents").select("doc_id", F.round(hashing.position("alloc", F.col("doc_id")), 9).alias("place"))


@query(f"SELECT doc_id, round({draw_sql('fam', 'source')}, 9) AS draw, ('0x' || substr(sha256(source), 1, 8))::BIGINT AS seed FROM documents")
def hash_draws(t):
    return t("documents").select("doc_id", F.round(hashing.closed_draw("fam", F.col("source")), 9).alias("draw"), hashing.order_seed(F.col("source")).alias("seed"))


@query("SELECT doc_id, substr(sha256(source || chr(10) || lang), 1, 16) AS newer, sha256(text) AS whole, substr(md5(text), 1, 12) AS short FROM documents")
def content_ids(t):
    return t("documents").select("doc_id", hashing.short_id("source", "lang", newer=True).alias("newer"), F.sha2("text", 256).alias("whole"), F.substring(F.md5("text"), 1, 12).alias("short"))


@query("SELECT event_id, sha256('{\"k\":' || (props->>'$.k') || '}') AS digest FROM events")
def canonical_digests(t):
    return t("events").select("event_id", hashing.canonical_digest(F.col("props")).alias("digest"))


@query("""
SELECT o_orderkey, round(least(greatest(o_totalprice / 1000, 10), 300), 3) AS clamped, CAST(floor(o_totalprice / 7) AS BIGINT) AS whole,
  round(o_totalprice / nullif(o_custkey % 5, 0), 3) AS share FROM orders
""")
def clamps_and_ratios(t):
    p = F.col("o_totalprice")
    return t("orders").select("o_orderkey", F.round(F.least(F.greatest(p / 1000, F.lit(10.0)), F.lit(300.0)), 3).alias("clamped"), F.floor(p / 7).cast("bigint").alias("whole"), F.round(stats.ratio(p, F.col("o_custkey") % 5), 3).alias("share"))


@query("""
WITH a AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority) AS x, list(DISTINCT o_orderpriority) FILTER (WHERE o_orderstatus = 'F') AS y FROM orders GROUP BY 1)
SELECT k, len(list_intersect(x, coalesce(y, []))) AS common, len(x) - len(list_intersect(x, coalesce(y, []))) AS rest,
  round(len(list_intersect(x, coalesce(y, []))) / len(x)::DOUBLE, 6) AS likeness FROM a
""")
def array_sets(t):
    g = t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_set("o_orderpriority").alias("x"), F.collect_set(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("y"))
    return g.select("k", F.size(F.array_intersect("x", "y")).cast("bigint").alias("common"), F.size(F.array_except("x", "y")).cast("bigint").alias("rest"), F.round(arrays.jaccard(F.col("x"), F.col("y")), 6).alias("likeness"))


@query("""
WITH o AS (SELECT user_id, list(event_type ORDER BY event_id) AS seq FROM events GROUP BY user_id)
SELECT a.user_id, (SELECT count(*) FROM unnest(range(1, 1000)) u(i) WHERE i <= least(len(a.seq), len(b.seq)) AND list_slice(a.seq, 1, i) = list_slice(b.seq, 1, i)) AS prefix
FROM o a JOIN o b ON b.user_id = a.user_id + 1
""")
def common_prefix(t):
    seq = t("events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]).alias("seq"))
    b = seq.select((F.col("user_id") - 1).alias("user_id"), F.col("seq").alias("other"))
    return seq.join(b, "user_id").select("user_id", arrays.common_prefix(F.col("seq"), F.col("other")).alias("prefix"))


@query("""
WITH e AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, event_type AS k, CASE WHEN user_id % 2 = 0 AND event_type = 'click' THEN 0 ELSE n END AS v FROM e
""")
def map_merge(t):
    g = t("events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    m = g.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    patch = F.when((F.col("user_id") % 2 == 0) & F.map_contains_key("m", "click"), F.create_map(F.lit("click"), F.lit(0).cast("bigint"))).otherwise(F.map_filter("m", lambda k, v: F.lit(False)))
    return m.select("user_id", F.explode(arrays.later_wins(F.col("m"), patch)).alias("k", "v"))


@query("""
WITH a AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 100), b AS (SELECT DISTINCT user_id, event_type FROM events WHERE value < 5)
SELECT a.user_id, string_agg(a.event_type, ',' ORDER BY a.event_type) AS common FROM a JOIN b ON a.user_id = b.user_id AND a.event_type = b.event_type GROUP BY 1
""")
def map_common_keys(t):
    make = lambda c: t("events").where(c).groupBy("user_id").agg(F.map_from_entries(F.collect_set(F.struct("event_type", F.lit(1).alias("one")))).alias("m"))
    j = make("value > 100").withColumnRenamed("m", "a").join(make("value < 5").withColumnRenamed("m", "b"), "user_id")
    out = j.select("user_id", F.array_join(F.array_sort(F.map_keys(arrays.in_common(F.col("a"), F.col("b")))), ",").alias("common"))
    return out.where("common <> ''")


@query("""
SELECT c_mktsegment, '[' || string_agg('{"n":' || CAST(c_nationkey AS VARCHAR) || ',"c":' || CAST(n AS VARCHAR) || '}', ',' ORDER BY c_nationkey) || ']' AS document
FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2) GROUP BY 1
""")
def json_grouped(t):
    g = t("customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("c"))
    return g.groupBy("c_mktsegment").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.col("c_nationkey").alias("n"), "c"))), lambda x: x)).alias("document"))


@query("SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, coalesce(props->>'$.a.b', 'none') AS nested FROM events")
def dotted_paths(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.coalesce(F.get_json_object("props", "$.a.b"), F.lit("none")).alias("nested"))


@query("SELECT event_id, CAST(epoch_us(ts) AS BIGINT) AS us FROM events")
def instants(t):
    said = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z"))
    return t("events").select("event_id", F.unix_micros(text.instant(said)).alias("us"))


@query("SELECT doc_id, len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS n FROM documents")
def word_tokens(t):
    return t("documents").select("doc_id", F.size(text.words(F.col("text"))).cast("bigint").alias("n"))


@query("SELECT conv_id, turn, trim(text) AS clean FROM conversations")
def cleaned_text(t):
    return t("conversations").select("conv_id", "turn", text.cleaned(F.col("text")).alias("clean"))


@query("""
SELECT c_custkey, list_distinct_ordered AS names FROM (SELECT o_custkey AS c_custkey, string_agg(o_orderpriority, '|' ORDER BY first_at, o_orderpriority) AS list_distinct_ordered
  FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS first_at FROM orders GROUP BY 1, 2) GROUP BY 1)
""")
def ordered_distinct(t):
    seq = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("s"))
    return seq.select("c_custkey", F.array_join(F.array_distinct(F.transform("s", lambda x: x["o_orderpriority"])), "|").alias("names"))
