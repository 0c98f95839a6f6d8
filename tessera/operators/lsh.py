"""Near-duplicate prompts by MinHash and banded locality-sensitive hashing, all in the JVM.

One md5 a shingle, then SIGNATURE affine permutations modulo a Mersenne prime below 2^31, so that no product leaves a bigint and
any SQL engine can repeat them. A bucket gives star edges to its first member, verified by signature agreement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hex_number
from ..functions.text import words
from ..sources.storage import cut
from .graphs import connected_components
from .windows import first_per

SIGNATURE, BANDS, ROWS, THRESHOLD, PRIME = 64, 16, 4, 0.6, 2_147_483_647


def constants(n: int = SIGNATURE) -> list[tuple[int, int]]:
    """Multipliers and offsets of the permutations, from a rule that SQL can repeat."""
    return [((1_103_515_245 * (i + 1) + 12_345) % PRIME, (69_069 * (i + 7) * (i + 7) + 1) % PRIME) for i in range(n)]


def shingles(w: Column, n: int = 3) -> Column:
    """Distinct n-grams of a column of words; fewer words are one shingle. The words must be a column of their own: an
    expression would be evaluated again for every n-gram."""
    many = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) < n, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(many))


def signatures(docs: DataFrame, key: str, text: str, n: int = SIGNATURE) -> DataFrame:
    """(key, s0..s{n-1}): minima by key with partial aggregation, so a long text never sits in one array of signatures."""
    worded = docs.select(key, words(F.col(text)).alias("_w"))
    exploded = worded.select(key, F.explode(shingles(F.col("_w"))).alias("g")).select(key, hex_number(F.md5("g"), 7).alias("h"))
    return exploded.groupBy(key).agg(*(F.min((F.col("h") * F.lit(a) + F.lit(b)) % F.lit(PRIME)).alias(f"s{i}") for i, (a, b) in enumerate(constants(n))))


def agreement(a: str, b: str, n: int = SIGNATURE) -> Column:
    """Share of equal slots of two signature structs."""
    return sum((F.col(f"{a}.s{i}") == F.col(f"{b}.s{i}")).cast("int") for i in range(n)) / F.lit(float(n))


def star_edges(sigs: DataFrame, key: str, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(a, b): bucket members joined to the bucket's smallest key where signatures agree enough."""
    keys = F.array(*(F.concat_ws("-", F.lit(str(band)), *(F.col(f"s{band * rows + r}").cast("string") for r in range(rows))) for band in range(bands)))
    members = sigs.select(F.col(key).alias("b"), F.explode(keys).alias("bucket"))
    first = members.groupBy("bucket").agg(F.min("b").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = members.join(first, "bucket").where("a < b").select("a", "b").distinct()
    slots = F.struct(*(f"s{i}" for i in range(bands * rows)))
    packed = sigs.select(F.col(key).alias("k"), slots.alias("s"))
    left, right = packed.select(F.col("k").alias("a"), F.col("s").alias("x")), packed.select(F.col("k").alias("b"), F.col("s").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(agreement("x", "y", bands * rows) >= threshold).select("a", "b")


def groups(docs: DataFrame, key: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """(node, component) of near-duplicate texts."""
    # four branches of the edges read the signatures
    edges = star_edges(cut(signatures(docs, key, text)), key, threshold)
    return connected_components(docs.select(F.col(key).alias("node")), edges)


def first_kept(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The first text of each group in key order."""
    g = groups(docs, key, text)
    return first_per(g, ["component"], [F.col("node")]).select(F.col("node").alias(key))


def claim_conflicts(members: DataFrame, claims: DataFrame) -> DataFrame:
    """Groups claimed by more than one owner: members (node, component), claims (node, owner)."""
    return members.join(claims, "node").groupBy("component").agg(F.countDistinct("owner").alias("owners")).where("owners > 1")
