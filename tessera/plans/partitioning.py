"""Graphs, near-duplicate groups and leak-proof allocation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graphs, lsh
from .registry import position_sql, query

_C = lsh.constants()
_SIG = ", ".join(f"min((h * {a} + {b}) % {lsh.PRIME}) AS s{i}" for i, (a, b) in enumerate(_C))
_SHINGLE_SQL = f"""
w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w)),
s AS (SELECT doc_id, {_SIG} FROM (SELECT doc_id, ('0x' || substr(md5(g), 1, 7))::BIGINT AS h FROM g) GROUP BY doc_id)
"""
_BUCKETS = ", ".join("'" + str(b) + "-' || " + " || '-' || ".join(f"s{b * 4 + r}" for r in range(4)) for b in range(16))
_AGREE = " + ".join(f"CASE WHEN x.s{i} = y.s{i} THEN 1 ELSE 0 END" for i in range(64))
_EDGE_SQL = f"""
m AS (SELECT doc_id AS b, unnest([{_BUCKETS}]) AS bucket FROM s), f AS (SELECT bucket, min(b) AS a FROM m GROUP BY bucket HAVING count(*) > 1),
p AS (SELECT DISTINCT f.a, m.b FROM m JOIN f ON m.bucket = f.bucket WHERE f.a < m.b),
e AS (SELECT p.a, p.b FROM p JOIN s x ON p.a = x.doc_id JOIN s y ON p.b = y.doc_id WHERE ({_AGREE}) / 64.0::DOUBLE >= 0.6::DOUBLE)
"""
_GROUP_SQL = f"""
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, label) AS (SELECT doc_id, doc_id FROM s UNION SELECT w.b, r.label FROM r JOIN both_ways w ON r.node = w.a),
c AS (SELECT node, min(label) AS component FROM r GROUP BY node)
"""


def _docs(t):
    return t("documents").select("doc_id", "text")


@query(f"WITH {_SHINGLE_SQL} SELECT doc_id, {', '.join(f's{i}' for i in range(lsh.SIGNATURE))} FROM s")
def minhash_signatures(t):
    return lsh.signatures(_docs(t), "doc_id", "text")


@query(f"WITH RECURSIVE {_SHINGLE_SQL}, {_EDGE_SQL} SELECT a, b FROM e")
def minhash_star_edges(t):
    return lsh.star_edges(graphs.cut(lsh.signatures(_docs(t), "doc_id", "text")), "doc_id")


@query(f"WITH RECURSIVE {_SHINGLE_SQL}, {_EDGE_SQL}, {_GROUP_SQL} SELECT node, component FROM c")
def minhash_groups(t):
    return lsh.groups(_docs(t), "doc_id", "text")


@query(f"WITH RECURSIVE {_SHINGLE_SQL}, {_EDGE_SQL}, {_GROUP_SQL} SELECT min(node) AS doc_id FROM c GROUP BY component")
def near_duplicate_keep_first(t):
    return lsh.first_kept(_docs(t), "doc_id", "text")


_NODE_EDGES = """
nodes AS (SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS node, source FROM documents),
e AS (SELECT 'doc:' || CAST(a AS VARCHAR) AS a, 'doc:' || CAST(b AS VARCHAR) AS b FROM (SELECT min(doc_id) OVER (PARTITION BY md5(text)) AS a, doc_id AS b FROM documents) WHERE a < b
      UNION ALL SELECT 'doc:' || CAST(doc_id AS VARCHAR), 'doc:' || CAST(doc_id + 7 AS VARCHAR) FROM documents WHERE doc_id % 11 = 0 AND doc_id + 7 IN (SELECT doc_id FROM documents))
"""
_COMPONENTS = """
bw AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, label) AS (SELECT node, node FROM nodes UNION SELECT bw.b, r.label FROM r JOIN bw ON r.node = bw.a),
c AS (SELECT node, min(label) AS component FROM r GROUP BY node)
"""


def _graph(t):
    d = t("documents").select("doc_id", "source", F.md5("text").alias("h"))
    name = lambda c: F.concat(F.lit("doc:"), F.col(c).cast("string"))
    nodes = d.select(name("doc_id").alias("node"), "source")
    first = d.groupBy("h").agg(F.min("doc_id").alias("a"))
    copies = d.join(first, "h").where("a < doc_id").select(name("a").alias("a"), name("doc_id").alias("b"))
    chain = d.where("doc_id % 11 = 0").select("doc_id", (F.col("doc_id") + 7).alias("other")).join(d.select(F.col("doc_id").alias("other")), "other").select(name("doc_id").alias("a"), name("other").alias("b"))
    return nodes, copies.union(chain)


@query(f"WITH RECURSIVE {_NODE_EDGES}, {_COMPONENTS} SELECT node, component FROM c")
def connected_components(t):
    nodes, edges = _graph(t)
    return graphs.connected_components(nodes, edges)


@query(f"WITH RECURSIVE {_NODE_EDGES}, {_COMPONENTS} SELECT component, substr(sha256(string_agg(node, chr(10) ORDER BY node)), 1, 16) AS cid FROM c GROUP BY component")
def component_ids(t):
    nodes, edges = _graph(t)
    return graphs.component_ids(graphs.connected_components(nodes, edges))


_ALLOCATE = f"""
ids AS (SELECT component, substr(sha256(string_agg(node, chr(10) ORDER BY node)), 1, 16) AS cid, CASE WHEN bool_or(source = 'src3') THEN 'system_test' WHEN bool_or(source = 'src5') THEN 'development' END AS holdout,
  CASE WHEN count(*) > 1 THEN 'group' ELSE 'single' END AS stratum FROM (SELECT c.node, c.component, n.source FROM c JOIN nodes n ON c.node = n.node) GROUP BY component),
need AS (SELECT stratum, p, greatest(0, CASE p WHEN 'train' THEN 3 ELSE 2 END - count(*) FILTER (WHERE holdout = p)) AS n, CASE p WHEN 'system_test' THEN 1 WHEN 'development' THEN 2 WHEN 'validation' THEN 3 ELSE 4 END AS o
  FROM ids, (VALUES ('system_test'), ('development'), ('validation'), ('train')) v(p) GROUP BY stratum, p),
edge AS (SELECT stratum, p, sum(n) OVER (PARTITION BY stratum ORDER BY o) - n AS low, sum(n) OVER (PARTITION BY stratum ORDER BY o) AS high FROM need),
pl AS (SELECT *, {position_sql('alloc', 'cid')} AS place FROM ids), fr AS (SELECT *, row_number() OVER (PARTITION BY holdout IS NULL, stratum ORDER BY place, cid) AS rank FROM pl),
al AS (SELECT component, cid, fr.stratum, coalesce(holdout, edge.p, CASE WHEN place < 0.7::DOUBLE THEN 'train' WHEN place < 0.8::DOUBLE THEN 'validation' WHEN place < 0.8::DOUBLE + 0.1::DOUBLE THEN 'development' ELSE 'system_test' END) AS partition
  FROM fr LEFT JOIN edge ON edge.stratum = fr.stratum AND fr.rank > edge.low AND fr.rank <= edge.high)
"""
_FRACTIONS = {"train": 0.7, "validation": 0.1, "development": 0.1, "system_test": 0.1}
_MINIMUMS = {"system_test": 2, "development": 2, "validation": 2, "train": 3}


def _allocated(t):
    nodes, edges = _graph(t)
    members = graphs.cut(graphs.connected_components(nodes, edges))
    ids = graphs.component_ids(members)
    declared = F.when(F.bool_or(F.col("source") == "src3"), "system_test").when(F.bool_or(F.col("source") == "src5"), "development")
    stratum = F.when(F.count("*") > 1, "group").otherwise("single")
    facts = members.join(nodes, "node").groupBy("component").agg(declared.alias("holdout"), stratum.alias("stratum"))
    comps = graphs.cut(ids.join(facts, "component"))
    return members, comps, graphs.allocate(comps, "alloc", _FRACTIONS, _MINIMUMS)


@query(f"WITH RECURSIVE {_NODE_EDGES}, {_COMPONENTS}, {_ALLOCATE} SELECT cid, stratum, partition FROM al")
def allocate_partitions(t):
    return _allocated(t)[2]


@query(f"WITH RECURSIVE {_NODE_EDGES}, {_COMPONENTS}, {_ALLOCATE} SELECT c.node, al.cid, al.partition FROM c JOIN al ON c.component = al.component")
def assigned_nodes(t):
    members, comps, out = _allocated(t)
    return members.join(comps.select("component", "cid"), "component").join(out.select("cid", "partition"), "cid").select("node", "cid", "partition")


@query(f"WITH RECURSIVE {_NODE_EDGES}, {_COMPONENTS}, {_ALLOCATE} SELECT v.p AS partition, count(al.cid) AS n FROM (VALUES ('train'), ('validation'), ('development'), ('system_test')) v(p) LEFT JOIN al ON al.partition = v.p GROUP BY 1")
def assignment_counts(t):
    from ..operators.aggregates import with_all

    out = _allocated(t)[2]
    return with_all(out.groupBy("partition").agg(F.count("*").alias("n")), list(graphs.FRACTION_ORDER), "partition")


@query(f"WITH RECURSIVE {_NODE_EDGES}, {_COMPONENTS} SELECT c.component, count(DISTINCT n.source) AS n FROM c JOIN nodes n ON c.node = n.node GROUP BY 1 HAVING count(DISTINCT n.source) > 1")
def component_single_valued(t):
    nodes, edges = _graph(t)
    return graphs.single_valued(graphs.connected_components(nodes, edges).join(nodes, "node"), "component", "source")


@query("""
WITH RECURSIVE e AS (SELECT n_nationkey // 3 AS parent, n_nationkey AS child FROM nation WHERE n_nationkey >= 3), t(root, node, depth) AS (SELECT n_nationkey, n_nationkey, 0 FROM nation WHERE n_nationkey < 3 UNION ALL SELECT t.root, e.child, t.depth + 1 FROM t JOIN e ON t.node = e.parent)
SELECT root, node, depth FROM t
""")
def tree_reachability(t):
    n = t("nation")
    edges = n.where("n_nationkey >= 3").select(F.expr("cast(n_nationkey div 3 as int)").alias("parent"), F.col("n_nationkey").alias("child"))
    return graphs.reachable(edges, n.where("n_nationkey < 3").select(F.col("n_nationkey").alias("root")))


@query("""
WITH RECURSIVE e AS (SELECT n_nationkey // 3 AS parent, n_nationkey AS child FROM nation WHERE n_nationkey >= 3), t(root, node) AS (SELECT n_nationkey, n_nationkey FROM nation WHERE n_nationkey < 3 UNION ALL SELECT t.root, e.child FROM t JOIN e ON t.node = e.parent)
SELECT t.node, t.root, n.n_regionkey AS partition FROM t JOIN nation n ON t.root = n.n_nationkey
""")
def descendants_inherit(t):
    n = t("nation")
    edges = n.where("n_nationkey >= 3").select(F.expr("cast(n_nationkey div 3 as int)").alias("parent"), F.col("n_nationkey").alias("child"))
    nodes = n.select(F.col("n_nationkey").alias("node"), F.col("n_regionkey").alias("partition"))
    return graphs.descendants(edges, nodes, ["partition"]).select("node", "root", "partition")


@query("SELECT o_custkey AS component, count(DISTINCT o_orderpriority) AS owners FROM orders WHERE o_totalprice > 300000 GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def claim_conflicts(t):
    o = t("orders").where("o_totalprice > 300000")
    return lsh.claim_conflicts(o.select(F.col("o_orderkey").alias("node"), F.col("o_custkey").alias("component")), o.select(F.col("o_orderkey").alias("node"), F.col("o_orderpriority").alias("owner")))


@query("""
SELECT 'task:' || CAST(o_orderkey AS VARCHAR) AS a, 'group:' || CAST(o_custkey AS VARCHAR) AS b FROM orders UNION SELECT 'group:' || CAST(c_custkey AS VARCHAR), 'site:' || CAST(c_nationkey AS VARCHAR) FROM customer
UNION SELECT 'site:' || CAST(n_nationkey AS VARCHAR), 'region:' || CAST(n_regionkey AS VARCHAR) FROM nation
""")
def task_graph_edges(t):
    name = lambda kind, c: F.concat(F.lit(kind + ":"), F.col(c).cast("string"))
    o = t("orders").select(name("task", "o_orderkey").alias("a"), name("group", "o_custkey").alias("b"))
    c = t("customer").select(name("group", "c_custkey").alias("a"), name("site", "c_nationkey").alias("b"))
    n = t("nation").select(name("site", "n_nationkey").alias("a"), name("region", "n_regionkey").alias("b"))
    return o.union(c).union(n).distinct()


@query(f"""
SELECT doc_id, CASE WHEN p < 0.7::DOUBLE THEN 'train' WHEN p < 0.7::DOUBLE + 0.15::DOUBLE THEN 'validation' ELSE 'system_test' END AS partition FROM (SELECT doc_id, {position_sql('g14', 'doc_id')} AS p FROM documents)
""")
def fraction_buckets(t):
    from ..functions.hashing import position

    return t("documents").select("doc_id", graphs.by_fraction(position("g14", F.col("doc_id")), {"train": 0.7, "validation": 0.15, "system_test": 0.15}).alias("partition"))


