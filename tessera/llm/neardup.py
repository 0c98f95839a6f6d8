"""Operator 3: MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

Every text gets SYMBOLS minimum hashes of its distinct 5-word shingles, cut to 16 bits: its signature, split into chunks. By the
pigeonhole principle two signatures that differ in at most ``chunks * (errors + 1) - 1`` symbols agree in some chunk but for
``errors`` symbols, so posting each chunk under all selections of ``symbols - errors`` of its symbols brings all such pairs
together, without exception. Nothing that comes after drops a linked pair among them: candidates are screened by a
bound that always holds. A text's parity sketch has one bit for each of n hash values, set where an odd number of its shingles
falls; two sketches differ in at most as many bits as the sets differ in shingles, and linked sets of x and y shingles differ in
at most (x + y) / 7. n grows with the set, four bits a shingle and 1024 at least, so the bound stays sharp for long texts. Pairs that remain
are confirmed on the full shingle sets.

No bucket is ever expanded into all its pairs up front:
1. texts with equal shingle sets become one class, so exact copies cost one row;
2. in each bucket every class meets the bucket's hub only, the class that shares most buckets with most others (the original
   of a group of near copies); confirmed links are contracted into components, which folds such a group into one;
3. only pairs of one bucket that still lie in different components are screened, each in the first bucket it shares; of each two
   components the closest pair is confirmed first, and after another contraction all pairs that still lie apart.
A link between texts of one component is never needed, so nothing is lost.

Defined results: null, empty and blank texts have no shingle, are linked with nothing and kept; texts of fewer than 5 words are
one shingle; a null doc_id has a null component and is kept; rows that repeat a doc_id are judged each by its own text, one
result row for each input row; a component is named by its least doc_id, so two of them may have one name where a doc_id stands for
different texts; an empty table gives an empty result; extra columns are ignored. All tables written on the way are deleted
in the end, but for the result's.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, saved, scratch, setting, spans, window_hashes
from .components import components

#: Words in a shingle, and the linking similarity in hundredths.
WORDS, PERCENT = 5, 75
#: Minimum hashes of a text, 16 bits each; symbols in a chunk; errors allowed in a chunk.
SYMBOLS, CHUNK, ERRORS = 25, 5, 2
#: Largest distance of signatures that the chunks guarantee to find.
INDEX_DISTANCE = SYMBOLS // CHUNK * (ERRORS + 1) - 1
#: Longs of the least parity sketch, and bits a shingle of longer ones.
SKETCH, SKETCH_BITS = 16, 4

_RNG = np.random.Generator(np.random.PCG64(20240501))
_FACTORS = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64)
#: Shingles hashed at once: bounds the memory that a very long text takes.
_BLOCK = 2048


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; only A-Z are lower-cased."""
    return np.unique(window_hashes(spans(text.encode("utf-8", "replace"), lower=True)[0], WORDS)) if text else np.empty(0, np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum hashes, 64 bits each."""
    out = np.full(SYMBOLS, np.uint64(2**64 - 1))
    for at in range(0, len(hashes), _BLOCK):
        np.minimum(out, ((hashes[at : at + _BLOCK][None, :] ^ _SHIFTS[:, None]) * _FACTORS[:, None]).min(axis=1), out=out)
    return out


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The parity sketch: a power of two of longs. Halves of a longer one, XORed, are the sketch of half its length."""
    n = 64 * SKETCH
    while n < SKETCH_BITS * len(hashes):
        n *= 2
    odd = np.bincount((hashes & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def folded(wide: np.ndarray) -> np.ndarray:
    return np.bitwise_xor.reduce(wide.reshape(-1, SKETCH), axis=0)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_hash (two longs), index (array of 16-bit symbols), odd (sketch of SKETCH longs), wide (a longer one, for more shingles)."""
    prepare(docs.sparkSession)

    @F.pandas_udf("n_shingles long, set_high long, set_low long, index array<smallint>, odd array<long>, wide array<long>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                found = shingles(text)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                high, low = np.frombuffer(digest, dtype="<i8").tolist()
                if len(found):
                    index = ((signature(found) >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
                    wide = sketch(found)
                    rows.append((len(found), high, low, index, folded(wide), wide if len(wide) > SKETCH else None))
                else:
                    rows.append((0, high, low, None, None, None))
            yield pd.DataFrame(rows, columns=["n_shingles", "set_high", "set_low", "index", "odd", "wide"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), sign(F.col("text")).alias("s")).select("doc_id", "text_hash", "s.*")


#: The symbols that a posting keeps: all selections of CHUNK - ERRORS symbols from each chunk, in a fixed order.
SELECTIONS = [tuple(c * CHUNK + k for k in kept) for c in range(SYMBOLS // CHUNK) for kept in combinations(range(CHUNK), CHUNK - ERRORS)]


def _postings(classes: DataFrame) -> DataFrame:
    """(id, slot, key) for all chunks and all selections of their symbols that leave out ERRORS of them."""
    keys = [F.xxhash64(F.lit(i), *(F.col("index").getItem(k) for k in kept)) for i, kept in enumerate(SELECTIONS)]
    return classes.select("id", F.posexplode(F.array(*keys)).alias("slot", "key"))


def _first_slot(a: Column, b: Column) -> Column:
    """The first selection in which two signatures agree: the one bucket of all they share that reports the pair."""
    same = [a.getItem(k) == b.getItem(k) for k in range(SYMBOLS)]
    found = None
    for i, kept in enumerate(SELECTIONS):
        hit = same[kept[0]]
        for k in kept[1:]:
            hit = hit & same[k]
        found = F.when(hit, i) if found is None else found.when(hit, i)
    return found


def _odd_apart(a: Column, b: Column) -> Column:
    total = None
    for i in range(SKETCH):
        n = F.bit_count(a.getItem(i).bitwiseXOR(b.getItem(i)))
        total = n if total is None else total + n
    return total


def _wide_apart(a: Column, b: Column) -> Column:
    """Differing bits of two longer sketches, at the length of the shorter; null if one side has none."""
    half = lambda x: F.zip_with(F.slice(x, F.lit(1), F.size(x) / 2), F.slice(x, F.size(x) / 2 + 1, F.size(x) / 2), lambda p, q: p.bitwiseXOR(q))
    apart = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, n: total + n)
    # linked sets differ in size by a third at most, so their sketches differ in length by one step at most
    return F.when(F.size(a) == F.size(b), apart(a, b)).when(F.size(a) == F.size(b) * 2, apart(half(a), b)).when(F.size(a) * 2 == F.size(b), apart(a, half(b)))


def _may_link(x: str, y: str) -> Column:
    """What holds for every linked pair: sizes alike, and sketches that differ in no more bits than linked sets differ in shingles."""
    c = lambda side, name: F.col(f"{side}.{name}")
    n, m = c(x, "n"), c(y, "n")
    most = (n + m) * (100 - PERCENT)
    alike = (F.greatest(n, m) * PERCENT <= F.least(n, m) * 100) & (_odd_apart(c(x, "odd"), c(y, "odd")) * (100 + PERCENT) <= most)
    return alike & (F.coalesce(_wide_apart(c(x, "wide"), c(y, "wide")), F.lit(0)) * (100 + PERCENT) <= most)


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b, by id) whose full shingle sets are similar enough. Texts travel, compressed, not sets."""
    prepare(docs.sparkSession)

    @F.pandas_udf("boolean")
    def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            last, own, out = None, None, []
            for x, y in zip(left, right, strict=True):
                if x is not last and x != last:  # a hub's pairs come together
                    last, own = x, shingles(x)
                other = shingles(y)
                both = len(own) + len(other)
                small, large = (own, other) if len(own) <= len(other) else (other, own)
                if 100 * len(small) < PERCENT * len(large):
                    out.append(False)
                    continue
                common = int(np.count_nonzero(large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small)) if len(large) else 0
                out.append(bool(common) and 100 * common >= PERCENT * (both - common))
            yield pd.Series(out, dtype=bool)

    b_side = docs.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    a_side = docs.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    joined = pairs.join(b_side, "b").join(a_side, "a")
    return joined.where(linked("a_text", "b_text")).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component (a node, null without shingles), component_id, kept."""
    with scratch(docs.sparkSession) as result:
        return result(_linked_documents(docs), "near-duplicates")


def _linked_documents(docs: DataFrame) -> DataFrame:
    signs = saved(signed(docs), "signs")
    sets = ["n_shingles", "set_high", "set_low"]
    full = signs.where("n_shingles > 0 and doc_id is not null")
    # a class carries one signature and one text, those of its least doc_id; equal sets have equal signatures
    least = F.min_by(F.struct("doc_id", "text_hash", "index", "odd", "wide"), F.struct("doc_id", "text_hash"))
    classes = saved(full.groupBy(*sets).agg(least.alias("l")).select(*sets, F.col("l.doc_id").alias("least"), "l.text_hash", "l.index", "l.odd", "l.wide"), "sets")
    # a class is a node by its least doc_id; of classes that share it (a doc_id with different texts) all but one go by a hash
    shared = saved(classes.groupBy("least").agg(F.count("*").alias("held"), F.min(F.struct(*sets)).alias("first")).where("held > 1"), "shared")
    repeated = bool(shared.take(1))
    if repeated:
        classes = classes.join(shared.select("least", "first"), "least", "left")
        own = F.col("first").isNull() | (F.struct(*sets) == F.col("first"))
        classes = saved(classes.withColumn("id", F.when(own, F.col("least")).otherwise(F.xxhash64(*sets))).drop("first"), "classes")
    else:
        classes = classes.withColumn("id", F.col("least"))
    posted = _postings(classes)
    buckets = posted.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    members = saved(posted.join(buckets, "key"), "members")
    weights = members.groupBy("id").agg(F.sum("held").alias("weight"))
    hubs = members.join(weights, "id").groupBy("key").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("hub"))
    nodes = classes.select("id", "index", "odd", "wide", F.col("n_shingles").alias("n"))
    # one text stands for a class
    wanted = classes.join(weights.select("id"), "id").select("id", F.col("least").alias("doc_id"), "text_hash")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(wanted, ["doc_id", "text_hash"])
    texts = saved(texts.select("id", "text").dropDuplicates(["id"]), "texts")

    stars = members.join(hubs, "key").where("id <> hub").select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()
    stars = stars.join(nodes.alias("x"), F.col("a") == F.col("x.id")).join(nodes.alias("y"), F.col("b") == F.col("y.id")).where(_may_link("x", "y"))
    stars = saved(stars.select("a", "b"), "stars")
    links = saved(_confirmed(stars, texts), "links")
    first = saved(components(links), "first")

    placed = members.select("key", "slot", "id").join(first, members["id"] == first["node"], "left").select("key", "slot", "id", F.coalesce("component", "id").alias("c"))
    # of a bucket's components the one with most members only has to meet the others
    shares = placed.groupBy("key", "c").agg(F.count("*").alias("n"))
    mixed = shares.groupBy("key").agg(F.count("*").alias("held"), F.max_by("c", F.struct("n", "c")).alias("major")).where("held > 1").select("key", "major")
    apart = placed.join(mixed, "key").select("key", "slot", "id", "c", (F.col("c") != F.col("major")).alias("minor"))
    look = saved(apart.join(nodes, "id"), "look")
    x, y = look.where("minor").alias("x"), look.alias("y")
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.c") != F.col("y.c")) & (~F.col("y.minor") | (F.col("x.id") < F.col("y.id")))
    meet = meet & _may_link("x", "y") & (_first_slot(F.col("x.index"), F.col("y.index")) == F.col("x.slot"))
    pairs = x.join(y, meet).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), F.least("x.c", "y.c").alias("low"), F.greatest("x.c", "y.c").alias("high"), (_odd_apart(F.col("x.odd"), F.col("y.odd")) / (F.col("x.n") + F.col("y.n"))).alias("apart"))
    # the condition's code is too large for the JIT in one method; below this limit Spark compiles it in parts instead
    with setting(docs.sparkSession, "spark.sql.codegen.hugeMethodLimit", "8000"):
        pairs = saved(pairs.join(stars, ["a", "b"], "left_anti"), "pairs")
    nearest = pairs.groupBy("low", "high").agg(F.min_by(F.struct("a", "b"), F.struct("apart", "a", "b")).alias("p")).select("p.*")
    edges = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    more = saved(_confirmed(nearest, texts), "more")
    if more.take(1):
        edges = edges.union(more)
        first = components(edges)
        tops = first.select("node", "component")
        # links between components, not nodes: a pair still lies apart if its components' new components differ
        pairs = pairs.join(tops.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(tops.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
    rest = pairs.select("a", "b").join(nearest, ["a", "b"], "left_anti")
    last = saved(_confirmed(rest, texts), "last")
    final = components(edges.union(last)) if last.take(1) else first

    by_class = classes.join(final, classes["id"] == final["node"], "left").select(*sets, "least", "id", F.coalesce("component", "id").alias("component"))
    if repeated:
        # components with a node that goes by a hash: their least doc_id isn't their least node
        by_class = saved(by_class, "by-class")
        named = by_class.join(by_class.where("id <> least").select("component").distinct(), "component").groupBy("component").agg(F.min("least").alias("name"))
        by_class = by_class.join(named, "component", "left").withColumn("component_id", F.coalesce("name", "component"))
    else:
        by_class = by_class.withColumn("component_id", F.col("component"))
    out = signs.select("doc_id", "text_hash", *sets).join(by_class.select(*sets, "component", "component_id"), sets, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "text_hash", "n_shingles", "component", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op3_near_duplicates(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: one document of each group stays, with the columns it came with."""
    found = near_duplicates(docs)
    # a doc_id may stand for texts of different components, each of which keeps one
    stay = found.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id", "component").agg(F.min("text_hash").alias("_text_hash"))
    names = docs.columns
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    known = keyed.join(stay.select("doc_id", "_text_hash"), ["doc_id", "_text_hash"], "left_semi").dropDuplicates(["doc_id", "_text_hash"]).select(*names)
    return known.unionByName(docs.where("doc_id is null"))
