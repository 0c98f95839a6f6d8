"""Filters and projections over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays, hashing, text
from ..operators import filters
from .registry import draw_sql, position_sql, query


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(text) BETWEEN 12 AND 2400")
def length_gate(t):
    return filters.length_gate(t("documents"), "text").select("doc_id", F.length("text").cast("bigint").alias("n"))


#: The rule for tokens as SQL over tokens split at white space and brackets, without a pattern for whole tokens: a folder and any ending, or a known ending.
_KNOWN = ", ".join(f"'{e}'" for e in text.EXTENSIONS)
_PATH_TOKENS = f"""
split_tokens AS (SELECT id, i, rtrim(t, '.') AS raw FROM (SELECT id, unnest(l) AS t, generate_subscripts(l, 1) AS i FROM (SELECT id, regexp_split_to_array(prompt, '[\\s,;()]+') AS l FROM prompts))),
cased AS (SELECT id, i, raw, string_split(raw, '/') AS p, string_split(list_last(string_split(raw, '/')), '.') AS e FROM split_tokens),
tokens AS (SELECT id, i, ltrim(raw, './') AS token FROM cased WHERE len(e) > 1 AND list_last(e) <> '' AND list_last(e) NOT LIKE '%-%'
  AND CASE WHEN len(p) > 1 THEN len(list_filter(p[:-2], lambda x: x = '')) = 0 AND length(list_last(p)) > length(list_last(e)) + 1 ELSE len(e) = 2 AND e[1] <> '' AND list_last(e) IN ({_KNOWN}) END)
"""
_PROMPTS = """
prompts AS (SELECT page_id AS id, 'see ' || regexp_extract(url, '^https?://([^?#]*)', 1) || '.html and docs/page' || CAST(page_id % 7 AS VARCHAR) || '.md, then setup.cfg (or package.json); v1.5 isn''t, e.g. here.'
  || CASE WHEN page_id % 3 = 0 THEN ' New: docs/extra.rst' ELSE '' END AS prompt FROM pages),
files AS (SELECT DISTINCT regexp_extract(url, '^https?://([^?#]*)', 1) || '.html' AS path FROM pages WHERE page_id % 4 > 0
          UNION SELECT 'site/docs/page' || CAST(x AS VARCHAR) || '.md' FROM range(0, 6) r(x) UNION SELECT 'setup.cfg' UNION SELECT 'web/package.json' UNION SELECT 'docs/index.md')
"""


def _prompts(t):
    path = F.regexp_extract("url", r"^https?://([^?#]*)", 1)
    said = F.concat(F.lit("see "), path, F.lit(".html and docs/page"), (F.col("page_id") % 7).cast("string"), F.lit(".md, then setup.cfg (or package.json); v1.5 isn't, e.g. here."))
    more = F.when(F.col("page_id") % 3 == 0, " New: docs/extra.rst").otherwise("")
    prompts = t("pages").select(F.col("page_id").alias("id"), F.concat(said, more).alias("prompt"))
    files = t("pages").where("page_id % 4 > 0").select(F.concat(path, F.lit(".html")).alias("path"))
    pages = files.sparkSession.range(6).select(F.concat(F.lit("site/docs/page"), F.col("id").cast("string"), F.lit(".md")).alias("path"))
    others = files.sparkSession.createDataFrame([("setup.cfg",), ("web/package.json",), ("docs/index.md",)], "path string")
    return prompts, files.union(pages).union(others).distinct()


@query(f"""
WITH {_PROMPTS}, {_PATH_TOKENS}, once AS (SELECT DISTINCT id, token FROM tokens)
SELECT p.id, count(k.token) AS mentions, coalesce(bool_and(EXISTS (SELECT 1 FROM files f WHERE f.path = k.token OR ends_with(f.path, '/' || k.token))) FILTER (WHERE k.token IS NOT NULL), true) AS all_known
FROM prompts p LEFT JOIN once k ON p.id = k.id GROUP BY p.id
""")
def path_gate(t):
    return filters.path_gate(*_prompts(t), "id", "prompt")


@query(f"""
WITH {_PROMPTS}, {_PATH_TOKENS}, once AS (SELECT DISTINCT id, token FROM tokens)
SELECT p.id, count(k.token) AS mentions, coalesce(bool_and(NOT contains(k.token, '/') OR EXISTS (SELECT 1 FROM files f WHERE f.path = k.token OR ends_with(f.path, '/' || k.token)
  OR starts_with(f.path, regexp_replace(k.token, '[^/]*$', '')))) FILTER (WHERE k.token IS NOT NULL), true) AS all_known
FROM prompts p LEFT JOIN once k ON p.id = k.id GROUP BY p.id
""")
def path_gate_new_files(t):
    return filters.path_gate(*_prompts(t), "id", "prompt", new_files=True)


@query("SELECT p_partkey, p_name, p_brand FROM part")
def exact_projection(t):
    return t("part").select("p_partkey", "p_name", "p_brand")


@query("""
SELECT p_partkey, p_name, len(list_filter(string_split(lower(p_name), ' '), lambda x: x IN ('red', 'widget', 'redwidget', 'cold', 'rod', 'coldrod'))) > 0 AS mentioned FROM part
""")
def mentions_identifier(t):
    return t("part").select("p_partkey", "p_name", text.mentions_identifier(F.col("p_name"), F.lit("redWidget"), F.lit("src/coldRod.spec.ts")).alias("mentioned"))


@query("""
WITH tok AS (SELECT conv_id, turn, text, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM conversations),
bare AS (SELECT *, list_transform(w, lambda x: CASE WHEN right(x, 1) IN ('.', ',', ';', ':', '!', '?') THEN left(x, -1) ELSE x END) AS b FROM tok)
SELECT conv_id, turn, len(w) >= 3 AND len(list_filter(b, lambda x: regexp_full_match(x, '[A-Za-z]+') OR regexp_full_match(x, '[A-Za-z][A-Za-z''’-]*'))) >= len(w) * 0.8::DOUBLE
  AND len(list_filter(string_split(text, ''), lambda c: c IN ('{', '}', '(', ')', ';', '=', '<', '>', '[', ']'))) = 0 AS prose FROM bare
""")
def prose_filter(t):
    return t("conversations").select("conv_id", "turn", text.is_prose(F.col("text")).alias("prose"))


@query("""
WITH u AS (SELECT 'conv' AS repo, 'src/' || role || '_Notes.py' AS file, turn AS line, CASE conv_id % 3 WHEN 0 THEN string_split(trim(text), ' ')[1] WHEN 1 THEN 'parseThing' ELSE 'r' END AS symbol,
  CASE WHEN conv_id % 5 = 0 THEN regexp_replace(text, ' ', ' user ') ELSE text END AS doc FROM conversations),
s AS (SELECT *, regexp_replace(doc, '^\\s+|\\s+$', '', 'g') AS whole FROM u),
c AS (SELECT *, coalesce(nullif(regexp_extract(whole, '^((?s:.*?)[.!?])\\s', 1), ''), whole) AS first FROM s WHERE whole <> ''),
k AS (SELECT *, CASE WHEN starts_with(first, symbol) THEN regexp_replace(substr(first, length(symbol) + 1), '^\\s+', '') ELSE first END AS task FROM c),
w AS (SELECT *, list_filter(regexp_split_to_array(task, '\\s+'), lambda x: x <> '') AS n, regexp_extract_all(lower(task), '[a-z0-9_]+') AS words FROM k),
b AS (SELECT *, list_transform(n, lambda x: CASE WHEN right(x, 1) IN ('.', ',', ';', ':', '!', '?') THEN left(x, -1) ELSE x END) AS bare,
  list_filter(regexp_split_to_array(lower(symbol), '[^a-z0-9]+'), lambda x: length(x) > 2) || [lower(symbol), lower(split_part(list_last(string_split(file, '/')), '.', 1)), regexp_extract(file, '/([a-z]*)_', 1), 'notes'] || CASE WHEN symbol = 'parseThing' THEN ['parse', 'thing'] ELSE [] END AS banned FROM w)
SELECT repo, file, line, symbol, task, list_aggregate(list_filter(regexp_extract_all(lower(task), '[a-z][a-z0-9]+'), lambda x: length(x) > 3)[1:3], 'string_agg', ' ') AS query, 'en' AS lang, 'docs' AS source
FROM b WHERE len(n) >= 6 AND len(list_filter(bare, lambda x: regexp_full_match(x, '[A-Za-z][A-Za-z''’-]*'))) >= len(n) * 0.8::DOUBLE
  AND len(list_filter(string_split(task, ''), lambda c: c IN ('{', '}', '(', ')', ';', '=', '<', '>', '[', ']'))) = 0 AND NOT list_has_any(words, banned)
""")
def doc_pairs(t):
    symbol = F.when(F.col("conv_id") % 3 == 0, F.element_at(F.split(F.trim("text"), " "), 1)).when(F.col("conv_id") % 3 == 1, "parseThing").otherwise("r")
    doc = F.when(F.col("conv_id") % 5 == 0, F.regexp_replace("text", "^([^ ]*) ", "$1 user ")).otherwise(F.col("text"))
    units = t("conversations").select(F.lit("conv").alias("repo"), F.concat(F.lit("src/"), F.col("role"), F.lit("_Notes.py")).alias("file"), F.col("turn").alias("line"), symbol.alias("symbol"), doc.alias("doc"))
    # a task without a longer word has no query: null here as in the SQL, empty in the operator
    return filters.doc_pairs(units).withColumn("query", F.nullif("query", F.lit("")))


@query("""
SELECT p_partkey, regexp_matches(lower(p_name), '(^|[^\\p{L}\\p{N}_-])red[-\\s]widget($|[^\\p{L}\\p{N}_-])') AS red_widget,
  regexp_matches(lower(p_name), '(^|[^\\p{L}\\p{N}_-])small[-\\s]ring($|[^\\p{L}\\p{N}_-])') AS small_ring FROM part
""")
def names_skill(t):
    out = filters.naming(t("part").withColumn("p_name", F.upper("p_name")), "p_name", ["red-widget", "small ring"])
    return out.select("p_partkey", F.array_contains("named", "red-widget").alias("red_widget"), F.array_contains("named", "small ring").alias("small_ring"))


@query("SELECT user_id, min(event_id) AS first_error FROM events WHERE event_type = 'error' GROUP BY user_id")
def first_matching(t):
    return t("events").where("event_type = 'error'").groupBy("user_id").agg(F.min("event_id").alias("first_error"))


@query(f"""
SELECT doc_id, source FROM documents WHERE lang = 'en' UNION ALL
SELECT doc_id, source FROM documents WHERE lang <> 'en' AND {draw_sql('7', 'source')} < 0.4::DOUBLE
""")
def mixed_rows_fraction(t):
    d = t("documents").select("doc_id", "source", "lang")
    return filters.mixed(d.where("lang = 'en'"), d.where("lang <> 'en'"), 0.4, "7", "source").select("doc_id", "source")


@query("""
SELECT event_id, CASE WHEN value > 200 THEN 'too_large' WHEN event_type = 'error' THEN 'failed' WHEN CAST(props->>'$.k' AS INTEGER) < 10 THEN 'low_code' END AS reason FROM events
""")
def first_exclusion_reason(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t("events").select("event_id", filters.first_reason((F.col("value") > 200, "too_large"), (F.col("event_type") == "error", "failed"), (k < 10, "low_code")).alias("reason"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 'grounded' WHEN o_orderstatus = 'F' THEN 'partial' WHEN o_orderstatus IS NULL THEN 'absent' ELSE 'open' END AS closeout FROM orders
""")
def closeout_class(t):
    s = F.col("o_orderstatus")
    return t("orders").select("o_orderkey", F.when((s == "F") & (F.col("o_totalprice") > 100000), "grounded").when(s == "F", "partial").when(s.isNull(), "absent").otherwise("open").alias("closeout"))


@query("""
SELECT d.doc_id, l.quality IS NOT DISTINCT FROM 1 AND l.toxic IS NOT DISTINCT FROM 0 AND d.n_chars >= 200 AND length(d.text) = d.n_chars AS ready FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def training_ready(t):
    j = t("documents").join(t("labels"), "doc_id", "left")
    return j.select("doc_id", (F.col("quality").eqNullSafe(F.lit(1)) & F.col("toxic").eqNullSafe(F.lit(0)) & (F.col("n_chars") >= 200) & (F.length("text") == F.col("n_chars"))).alias("ready"))


@query("""
SELECT o_custkey, len(list_filter(list(DISTINCT o_orderstatus), lambda x: x NOT IN ('F', 'O'))) = 0 AS only_known FROM orders GROUP BY o_custkey
""")
def code_subset(t):
    return t("orders").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("s")).select("o_custkey", arrays.is_subset(F.col("s"), F.array(F.lit("F"), F.lit("O"))).alias("only_known"))


@query("""
SELECT conv_id, bool_or(role = 'system') AS has_system, CASE WHEN bool_or(role = 'system') THEN 'runtime_system' ELSE 'plain' END AS stratum FROM conversations GROUP BY conv_id
""")
def stratum_relabel(t):
    turns = t("conversations").groupBy("conv_id").agg(F.bool_or(F.col("role") == "system").alias("has_system"))
    return turns.select("conv_id", "has_system", F.when(F.col("has_system"), "runtime_system").otherwise("plain").alias("stratum"))


@query("SELECT page_id FROM pages WHERE position('div' IN lower(html)) > 0 AND position('href' IN lower(html)) > 0")
def all_words_filter(t):
    return t("pages").where(text.matches_all(F.col("html"), "DIV href")).select("page_id")


@query("""
WITH bars(name, at_least) AS (VALUES ('click', 50.0::DOUBLE), ('view', 49.0::DOUBLE), ('error', 55.0::DOUBLE), ('refund', 1.0::DOUBLE)),
m AS (SELECT event_type AS name, avg(value) AS value FROM events GROUP BY 1)
SELECT b.name, b.at_least, round(m.value, 6) AS value FROM bars b LEFT JOIN m ON b.name = m.name WHERE m.value IS NULL OR m.value < b.at_least
""")
def failed_bars(t):
    m = t("events").groupBy(F.col("event_type").alias("name")).agg(F.avg("value").alias("value"))
    bars = m.sparkSession.createDataFrame([("click", 50.0), ("view", 49.0), ("error", 55.0), ("refund", 1.0)], "name string, at_least double")
    return filters.failed_bars(bars, m).withColumn("value", F.round("value", 6))


@query("""
WITH a AS (SELECT n_nationkey AS k, n_regionkey AS v FROM nation WHERE n_nationkey < 20), b AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN 100 + n_regionkey END AS v FROM nation WHERE n_nationkey >= 5)
SELECT coalesce(a.k, b.k) AS k, coalesce(b.v, a.v) AS v FROM a FULL JOIN b ON a.k = b.k
""")
def calibrated_overlay(t):
    n = t("nation")
    a = n.where("n_nationkey < 20").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("v"))
    b = n.where("n_nationkey >= 5").select(F.col("n_nationkey").alias("k"), F.expr("case when n_nationkey % 3 = 0 then 100 + n_regionkey end").alias("v"))
    return filters.overlay(a, b, ["k"], ["v"])


@query("""
WITH c AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 1 END AS at_least, CASE WHEN doc_id % 3 = 0 THEN 0 END AS at_most FROM documents WHERE doc_id % 5 = 0)
SELECT c.doc_id, c.at_least, c.at_most, l.quality AS score FROM c LEFT JOIN labels l ON c.doc_id = l.doc_id WHERE NOT coalesce(l.quality BETWEEN coalesce(c.at_least, 0) AND coalesce(c.at_most, 4), false)
""")
def failed_controls(t):
    c = t("documents").where("doc_id % 5 = 0").select("doc_id", F.expr("case when doc_id % 2 = 0 then 1 end").alias("at_least"), F.expr("case when doc_id % 3 = 0 then 0 end").alias("at_most"))
    return filters.failed_controls(c, t("labels").select("doc_id", F.col("quality").alias("score")), ["doc_id"])


@query("""
SELECT o_custkey, CASE WHEN bool_and(k = 'human') THEN 'labelled' WHEN bool_or(k = 'skip') THEN 'skipped' WHEN bool_or(k = 'automatic') THEN 'automatic' ELSE 'open' END AS state
FROM (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'human' WHEN 'P' THEN 'skip' ELSE 'automatic' END AS k FROM orders) GROUP BY o_custkey
""")
def item_states(t):
    d = t("orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", "human").when(F.col("o_orderstatus") == "P", "skip").otherwise("automatic").alias("kind"))
    return filters.item_states(d, "o_custkey")


@query(f"""
WITH {_PROMPTS}, {_PATH_TOKENS}, hits AS (SELECT k.id, arg_min(f.path, k.i) AS mentioned FROM (SELECT k.id, k.i, max(f.path) FILTER (WHERE f.path = k.token) AS exact, max(f.path) AS named
  FROM tokens k JOIN files f ON f.path = k.token OR list_last(string_split(f.path, '/')) = k.token GROUP BY 1, 2) k, LATERAL (SELECT coalesce(k.exact, k.named) AS path) f GROUP BY 1)
SELECT p.id, CASE WHEN {draw_sql('ref', 'p.id')} < 0.3::DOUBLE THEN coalesce(h.mentioned, 'README.md') END AS reference FROM prompts p LEFT JOIN hits h ON p.id = h.id
""")
def reference_appended(t):
    return filters.reference_appended(*_prompts(t), "id", "prompt", F.lit("README.md"), "ref", 0.3).select("id", "reference")


@query("""
SELECT conv_id, turn FROM conversations WHERE role = 'assistant'
""")
def nested_partition(t):
    rows = t("conversations").select("conv_id", "turn", F.struct(F.when(F.col("turn") >= 0, F.col("role")).alias("split")).alias("meta"))
    return filters.of_partition(rows, "assistant").select("conv_id", "turn")


@query("""
SELECT l_orderkey, list_sort(list_filter(list(DISTINCT l_returnflag), lambda x: x <> 'R')) AS candidates FROM lineitem GROUP BY l_orderkey
""")
def candidate_sets(t):
    g = t("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("s"))
    return g.select("l_orderkey", F.array_sort(F.array_except("s", F.array(F.lit("R")))).alias("candidates"))


@query("""
SELECT CAST(n_nationkey AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS task, n_regionkey AS grp, i AS variant FROM nation, unnest(range(0, 3)) u(i) WHERE i <= n_regionkey % 3
""")
def variants_expanded(t):
    n = t("nation").withColumn("variants", F.sequence(F.lit(0), F.col("n_regionkey") % 3))
    return n.select("n_nationkey", "n_regionkey", F.posexplode("variants").alias("i", "v")).select(F.concat_ws("-", F.col("n_nationkey").cast("string"), F.col("i").cast("string")).alias("task"), F.col("n_regionkey").alias("grp"), F.col("i").cast("bigint").alias("variant"))


@query("SELECT event_id, coalesce(props->>'$.group', 'user:' || CAST(user_id AS VARCHAR)) AS grp FROM events")
def group_key_fallback(t):
    return t("events").select("event_id", F.coalesce(F.get_json_object("props", "$.group"), F.concat(F.lit("user:"), F.col("user_id").cast("string"))).alias("grp"))


@query(f"SELECT doc_id, {position_sql('strata', 'doc_id')} < 0.25::DOUBLE AS drawn FROM documents")
def stratum_draw(t):
    return t("documents").select("doc_id", (hashing.position("strata", F.col("doc_id")) < 0.25).alias("drawn"))
