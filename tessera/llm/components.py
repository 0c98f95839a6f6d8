"""Connected components of a link table by alternating star contractions; no neighbour list is ever collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, scratch

#: Rounds after which something must be wrong: the number needed grows with the logarithm of a component's size.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node points its larger neighbours at the smallest node it knows."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node (a, its smaller neighbours b) points them and itself at the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) with component the smallest node reachable; nodes without links don't appear. Nulls and loops are dropped."""
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    with scratch(links.sparkSession) as result:
        edges = saved(edges, "edges")
        before = None
        for _ in range(MOST_ROUNDS):
            edges = saved(_small_star(_large_star(edges)), "edges")
            now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if now == before or now[0] == 0:
                break
            before = now
        else:
            raise RuntimeError("components did not settle")
        stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        return result(stars.union(stars.select(F.col("component").alias("node"), "component").distinct()), "components")
