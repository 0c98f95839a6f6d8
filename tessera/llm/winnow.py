r"""Operator 7 [native]: document fingerprints by winnowing.

Units are runs without white space of at most UNIT code points (words) and, in longer runs (text without spaces), the UNIT code
points from every place of the run on, so that a gram starts at every code point there. A gram is GRAM units in a row. Its hash rolls: it
is a polynomial in its units' hashes modulo the prime 2^31 - 1, put together from the hashes of its two halves, so all grams take
log2(GRAM) passes over the units and no gram is hashed afresh. Every WINDOW grams in a row select the one with the least hash, the
rightmost among equals. Two texts that share GRAM + WINDOW - 1 units in a row share a selected gram: as many words, or
UNIT + GRAM + WINDOW - 2 code points of a longer run, wherever it stands in its run. Kept with its hash is a gram's position, the
index of its first unit.

All of it is array work in the JVM: a gram is one long, hash << 32 | (2^32 - 1 - position), so that the minimum of longs is the
selection rule, ties included.

Defined results: a null text counts as an empty one; a text without units has an empty fingerprint; a text of fewer than GRAM
units is one gram, of fewer than WINDOW grams one window; two empty fingerprints are alike 1.0, an empty and a full one 0.0;
documents follow each other by (doc_id, hash of the text, text), null ids first, the last by the first; the only document follows itself; rows that repeat
a doc_id follow each other; extra columns are ignored by the query and kept by with_fingerprint, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_rows, saved

#: Units in a gram, grams in a window, most code points in a unit.
GRAM, WINDOW, UNIT = 4, 4, 12
#: The modulus and the base of the polynomial; products of two remainders fit into a long.
PRIME, BASE = 2**31 - 1, 1_000_003
#: Bits of the distinct ids in a block of neighbours. Rows from which a block is dealt out further, by hash.
NEIGHBOURS, HOT_ROWS, HOT_PARTS = 7, 4096, 4096
#: A run, or its next 2 UNIT - 1 code points: the units that start in the first UNIT of them. Only those are passed over then.
_PATTERN = rf"(?=([^\x20\x09-\x0D]{{1,{2 * UNIT - 1}}}+))(?:\1(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]{{{UNIT}}})"


def pieces(text: Column) -> Column:
    """Words, and longer runs in steps of UNIT code points, each with what its units reach into."""
    return F.regexp_extract_all(text, F.lit(_PATTERN), F.lit(1))


def _unit_hash(unit: Column) -> Column:
    return F.pmod(F.xxhash64(unit), F.lit(PRIME))


def unit_hashes(found: Column) -> Column:
    """Hashes of all units; of the pieces themselves where all are words."""
    starts = lambda w: F.greatest(F.char_length(w) - (UNIT - 1), F.lit(1))
    every = F.transform(found, lambda w: F.transform(F.sequence(F.lit(1), starts(w)), lambda k: _unit_hash(F.substring(w, k, F.lit(UNIT)))))
    return F.when(F.exists(found, lambda w: F.char_length(w) > UNIT), F.flatten(every)).otherwise(F.transform(found, _unit_hash))


def joined_hashes(left: Column, right: Column, apart: int, length: int) -> Column:
    """Hashes of runs that start at every unit: left's run there, and right's run of `length` units that starts `apart` units later."""
    factor = F.lit(pow(BASE, length, PRIME))
    return F.transform(left, lambda h, i: F.pmod(h * factor + F.coalesce(F.get(right, i + apart), F.lit(0)), F.lit(PRIME)))


def _packed(hashes: Column, gram: int) -> Column:
    """Grams as longs that order by (hash, later position first). A text of fewer units is one gram of all of them."""
    count = F.when(F.size(hashes) == 0, 0).otherwise(F.greatest(F.size(hashes) - (gram - 1), F.lit(1)))
    return F.transform(F.slice(hashes, 1, count), lambda h, i: h * F.lit(2**32) + (F.lit(2**32 - 1) - i.cast("long")))


def _selected(packed: Column, window: int) -> Column:
    """Distinct minima of the windows, in order of position; a text of fewer grams has one window."""
    count = F.when(F.size(packed) == 0, 0).otherwise(F.greatest(F.size(packed) - (window - 1), F.lit(1)))
    return F.array_distinct(F.transform(F.slice(packed, 1, count), lambda p, i: F.least(p, *(F.get(packed, i + k) for k in range(1, window)))))


def gram_hash(packed: Column) -> Column:
    return F.shiftright(packed, 32)


def gram_position(packed: Column) -> Column:
    return F.lit(2**32 - 1) - packed.bitwiseAND(F.lit(2**32 - 1))


def with_picks(df: DataFrame, text: str, to: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds the selected grams of a text column, packed. Steps are columns of their own, so none is evaluated twice."""
    if gram < 1 or window < 2:
        raise ValueError("a gram has a unit at least, a window two grams")
    name = lambda n: f"_{to}_{n}"
    df = df.withColumn(name("pieces"), pieces(F.coalesce(F.col(text), F.lit("")))).withColumn(name(1), unit_hashes(F.col(name("pieces")))).drop(name("pieces"))
    lengths = [gram]
    for n in lengths:  # a run of n units is one of n // 2 and one of the rest
        lengths += [x for x in dict.fromkeys((n // 2, n - n // 2)) if n > 1 and x not in lengths]
    for n in sorted(lengths)[1 if 1 in lengths else 0 :]:
        df = df.withColumn(name(n), joined_hashes(F.col(name(n // 2)), F.col(name(n - n // 2)), n // 2, n - n // 2))
    df = df.withColumn(name("grams"), _packed(F.col(name(gram)), gram)).drop(*(name(n) for n in lengths))
    return df.withColumn(to, _selected(F.col(name("grams")), window)).drop(name("grams"))


def said(picked: Column) -> Column:
    """A fingerprint as text: position:hash, joined by commas."""
    return F.array_join(F.transform(picked, lambda p: F.concat(gram_position(p).cast("string"), F.lit(":"), F.hex(gram_hash(p)))), ",")


def hashes_of(picked: Column) -> Column:
    return F.array_distinct(F.transform(picked, lambda p: gram_hash(p).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all hashes of two fingerprints (arrays of distinct hashes)."""
    common = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b) - common
    return F.when(both == 0, F.lit(1.0)).otherwise(common / both)


def with_fingerprint(docs: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """The operator: adds an array of (position, hash) to a frame, whatever its other columns are called."""
    df = with_picks(as_rows(docs), f"row.`{text}`", "picks")
    found = F.transform("picks", lambda p: F.struct(gram_position(p).alias("position"), gram_hash(p).alias("hash")))
    return df.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != to), found.alias(to))


def _followers(nodes: DataFrame) -> DataFrame:
    """(block, part, next_block, next_part) for distinct (block, part), the last one's next being the first.

    Parts follow each other within their block, blocks within blocks of 2^NEIGHBOURS blocks, and so on up to one
    on either side of zero: nine levels at most, and no task sees more than the members of one block.
    """
    at = W.partitionBy("block").orderBy("part")
    first = saved(nodes.groupBy("block").agg(F.min("part").alias("part")), "blocks")
    levels = [first.select("block", F.col("block").alias("least"))]
    up = F.shiftright("block", NEIGHBOURS)
    while levels[-1].where("block not in (-1, 0)").take(1):
        levels.append(saved(levels[-1].groupBy(up.alias("block")).agg(F.min("least").alias("least")), "blocks"))
    # `after`: the least block (of level 0) that follows all below a block; at the top, of two rows at most, the circle closes
    top = W.orderBy("block")
    after = levels.pop().select("block", F.coalesce(F.lead("least").over(top), F.first("least").over(top)).alias("after"))
    for level in reversed(levels):
        inside = level.withColumn("up", up).withColumn("own", F.lead("least").over(W.partitionBy("up").orderBy("block")))
        after = inside.join(after.select(F.col("block").alias("up"), "after"), "up").select("block", F.coalesce("own", "after").alias("after"))
    starts = first.select(F.col("block").alias("after"), F.col("part").alias("after_part"))
    after = after.join(starts, "after")
    own = nodes.withColumn("own", F.lead("part").over(at)).join(after, "block")
    return own.select("block", "part", F.when(F.col("own").isNull(), F.col("after")).otherwise(F.col("block")).alias("next_block"), F.coalesce("own", "after_part").alias("next_part"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, picks, next_text, next_picks: each document with the next one by (doc_id, hash of the text, text), the last with the first.

    Documents are dealt by the block of ids they lie in, so one shuffle brings neighbours together; only the first
    document of each block travels once more, to the block before it. A block of HOT_ROWS rows or more (an id, or none, that stands
    for many texts) is dealt out by id and leading bits of the hash, in the same order; only equal rows can't be parted.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    # null ids come first, in a block of their own, before that of the least long
    rows = rows.withColumn("block", F.coalesce(F.shiftright("doc_id", NEIGHBOURS), F.lit(-(2**62))))
    fine = F.coalesce(F.pmod("doc_id", F.lit(2**NEIGHBOURS)), F.lit(0)) * HOT_PARTS + F.floor((F.col("h").cast("double") / F.lit(2.0**64) + F.lit(0.5)) * F.lit(HOT_PARTS - 1))
    hot = saved(rows.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_ROWS).select("block", F.lit(True).alias("hot")), "hot")
    if hot.take(1):
        rows = rows.join(hot, "block", "left").withColumn("part", F.when(F.col("hot"), fine).otherwise(F.lit(0)).cast("long")).drop("hot")
    else:
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    key = ["block", "part"]
    first = F.min_by("text", F.struct("doc_id", "h", "text"))
    firsts = saved(rows.groupBy(*key).agg(first.alias("first_text")), "firsts")
    follow = _followers(firsts.select(*key))
    texts = firsts.select(F.col("block").alias("next_block"), F.col("part").alias("next_part"), F.col("first_text").alias("text"))
    # the first document of the next block stands at the end of a block as a guest
    guests = follow.join(texts, ["next_block", "next_part"]).select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(None).cast("long").alias("h"), *key, F.lit(1).alias("guest"))
    every = rows.select("doc_id", "text", "h", *key, F.lit(0).alias("guest")).unionByName(guests)
    order = ["guest", "doc_id", "h", "text"]
    # dealt and sorted here, so that fingerprints are taken once a row, between the shuffle and the window, which needs no other
    every = with_picks(every.repartition(*key).sortWithinPartitions(*key, *order), "text", "picks")
    every = every.withColumn("hashes", hashes_of(F.col("picks")))
    after = W.partitionBy(*key).orderBy(*order)
    return every.withColumns({"next_text": F.lead("text").over(after), "next_hashes": F.lead("hashes").over(after)}).where("guest = 0").select("doc_id", "text", "picks", "hashes", "next_text", "next_hashes")


def op7_winnow_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and its likeness to the edited text's and to the next document's."""
    both = with_next(docs)
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "picks", "hashes", likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
    both = with_picks(both, "edited", "changed").withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    near = likeness(F.col("hashes"), hashes_of(F.col("changed")))
    return both.select("doc_id", "n_chars", "edited_sha256", said(F.col("picks")).alias("fingerprint"), said(F.col("changed")).alias("edited_fingerprint"), near.alias("near_edited"), "near_next", F.size("picks").alias("n_picks"))
