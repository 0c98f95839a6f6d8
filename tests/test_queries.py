"""Queries against the SQL engine over the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else str(int(v)) if v == int(v) and abs(v) < 1e15 else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    theirs = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert mine == theirs


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {r["partition"] for r in rows} <= {"train", "validation", "development", "system_test"}


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_doc_pairs_without_longer_words(spark, tmp_path):
    said = ["It was in all of the, was it.", "It was the first of all longer sentences.", "Too short."]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(said)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = catalog.queries()["doc_pairs"](spark, str(tmp_path)).select("line", "query").collect()
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = c.execute(f"select line, query from ({catalog.oracle_sql()['doc_pairs']}) order by line").fetchall()
    assert sorted(tuple(r) for r in got) == want == [(0, None), (1, "first longer sentences")]
