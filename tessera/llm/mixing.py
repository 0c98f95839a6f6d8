"""Operator 9 [native]: mixing sources to target weights along a time-varying curriculum.

Every source owns a weight and a schedule. The weights fix how many words the mix takes of each source (``source_targets``);
the schedule says when they come: a piecewise-linear density over training time 0..1 whose integral is the source's
cumulative demand. A document occupies an interval of its source's cumulative demand, and inverting the integral at the middle of
that interval gives its training position. Sorting by position over ranges gives the training order.

Everything is DataFrame work. Cumulative sums run in two levels, (source, slice of the hash space) and then rows within
one slice, so no task ever holds a whole source, however large the source is.

Defined results: a null text has size 0; documents of size 0 take nothing; a null source is a source of its own, last in
order; repeated rows are separate documents and share the demand like any others; documents of equal positions follow each other by
id; an empty table gives an empty mix; extra columns of the input are ignored. Sources are configuration-sized: one row for each goes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, as_rows, saved

#: Weights given to sources in code point order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: The mix holds this many times all words.
SHARE = 1.5
#: No source and no document is taken more often than this.
MOST = 2.0
#: Schedules by weight position: densities at the knots of KNOTS, each integrating to 1. Heavy sources come early, light ones late.
KNOTS = (0.0, 0.5, 1.0)
SCHEDULES = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5), (0.75, 1.25, 0.75))
#: Rows wanted in one slice of a source.
SLICE_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, rank, weight, source_size, target) for frames with source and size.

    Proportional shares with caps, the excess reshared by weight until none is above, is the water level L with
    target = least(most * size, L * weight). Sorting sources by the level at which they hit their cap makes L a running sum; a
    frame of one row a source is all that this needs.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ordered = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("rank", F.row_number().over(ordered) - 1).withColumn("weight", weight)
    cap = F.col("source_size") * F.lit(float(most))
    level = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    all_rows = W.partitionBy()
    per = per.withColumn("cap", cap).withColumn("wanted", F.sum("source_size").over(all_rows) * F.lit(float(share)))
    before = level.rowsBetween(W.unboundedPreceding, -1)
    after = level.rowsBetween(0, W.unboundedFollowing)
    per = per.withColumn("at", (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # the first source, by level, that the water does not fill gives the level for it and for all after it
    reached = F.min(F.when(F.col("at") * F.col("weight") <= F.col("cap"), F.col("cap") / F.col("weight"))).over(all_rows)
    per = per.withColumn("first", F.col("cap") / F.col("weight") >= reached)
    per = per.withColumn("level", F.max(F.when(F.col("cap") / F.col("weight") == reached, F.col("at"))).over(all_rows))
    target = F.when(F.col("first"), F.least(F.col("level") * F.col("weight"), F.col("cap"))).otherwise(F.col("cap"))
    return per.select("source", "rank", "weight", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _inverted(share: Column, schedule: Column, knots=KNOTS) -> Column:
    """Time at which a schedule's integral reaches `share` of its total: the area under each linear piece is a quadratic."""
    points = [schedule.getItem(i) for i in range(len(knots))]
    areas = [(points[i] + points[i + 1]) * F.lit((knots[i + 1] - knots[i]) / 2) for i in range(len(knots) - 1)]
    total = sum(areas[1:], areas[0])
    want = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * total
    found, done = None, F.lit(0.0)
    for i, area in enumerate(areas):
        width, low = knots[i + 1] - knots[i], points[i]
        slope = (points[i + 1] - low) / F.lit(width)
        rest = want - done
        # low * x + slope * x^2 / 2 = rest, in the form that is stable for small slopes
        root = F.sqrt(F.greatest(low * low + F.lit(2.0) * slope * rest, F.lit(0.0)))
        x = F.coalesce(F.lit(2.0) * rest / F.nullif(low + root, F.lit(0.0)), F.lit(0.0))
        at = F.lit(knots[i]) + F.least(x, F.lit(width))
        last = i == len(areas) - 1
        case = at if last else F.when(want <= done + area, at)
        found = case if found is None else F.coalesce(found, case)
        done = done + area
    return found


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, schedules=SCHEDULES, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, size, text_hash, source_size, target, taken, times, start (words of its source before it), position, position_again.

    Documents are taken in the order of a seeded hash. A target up to the source's size takes documents until the target is
    met; a larger target takes all of them once and those up to the rest again. A document whose interval holds the boundary
    is taken if the boundary lies past its middle, so a source ends within half a document of its target.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    # a fixed place in its source for each row; equal rows share it, and any order among them gives the same result
    sized = saved(sized.withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "text_hash")), "mix-sizes")
    targets = source_targets(sized, weights, share, most).withColumn("schedule", F.element_at(F.array(*(F.array(*map(F.lit, s)) for s in schedules)), (F.pmod(F.col("rank"), F.lit(len(schedules))) + 1).cast("int")))
    slices = max(1, -(-sized.count() // SLICE_ROWS))
    sized = sized.withColumn("slice", F.floor((F.col("place").cast("double") / F.lit(2.0**64) + F.lit(0.5)) * F.lit(slices)).cast("long"))
    per_slice = sized.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    ahead = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    per_slice = per_slice.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words")
    dealt = per_slice.join(targets, per_slice["source"].eqNullSafe(targets["source"])).select(per_slice["source"], "slice", "ahead", "rank", "source_size", "target", "schedule")
    inside = W.partitionBy("source", "slice").orderBy("place", "doc_id", "text_hash").rowsBetween(W.unboundedPreceding, -1)
    sized = sized.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = sized.alias("d").join(dealt.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.slice") == F.col("s.slice")))
    start = F.col("ahead") + F.col("within")
    middle = start + F.col("size") / F.lit(2.0)
    once = F.least(F.col("target"), F.col("source_size").cast("double"))
    again = F.greatest(F.col("target") - F.col("source_size"), F.lit(0.0))
    times = F.when(F.col("size") == 0, 0).otherwise((middle <= once).cast("int") + (middle <= again).cast("int"))
    out = joined.select("doc_id", F.col("d.source").alias("source"), "size", "text_hash", "source_size", "target", start.alias("start"), times.alias("times"), "schedule")
    out = out.withColumn("taken", (F.col("times") * F.col("size")).cast("long"))
    demand = (F.col("start") + F.col("size") / F.lit(2.0)) / F.nullif(F.col("target"), F.lit(0.0))
    first = F.when(F.col("times") >= 1, _inverted(demand, F.col("schedule")))
    second = F.when(F.col("times") >= 2, _inverted(demand + F.col("source_size") / F.nullif(F.col("target"), F.lit(0.0)), F.col("schedule")))
    return out.withColumn("position", first).withColumn("position_again", second).drop("schedule")


def curriculum(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """The training order: a row for each time a document is taken, range-sorted by position."""
    takes = mixed.withColumn("at", F.explode(F.filter(F.array("position", "position_again"), lambda x: x.isNotNull()))).drop("position", "position_again")
    keys = ("at", "doc_id", "text_hash")
    takes = takes.repartitionByRange(partitions, *keys) if partitions else takes.repartitionByRange(*keys)
    return takes.sortWithinPartitions(*keys).withColumnRenamed("at", "position")


def op9_curriculum_mix(docs: DataFrame) -> DataFrame:
    """The contract's columns over the whole table, range-sorted by first position (documents the mix leaves out come last)."""
    out = mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "position", "position_again")
    key = F.coalesce(F.col("position"), F.lit(2.0))
    return out.withColumn("key", key).repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id").drop("key")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: documents as often as the mix takes them, in training order, with the columns they came with.

    A row is known by its id, source, size and the hash of its text. Rows that agree in all of these are copies; each time the mix takes one of
    them, one row of theirs stands, so unlike texts under one id and copies alike are taken as often as planned.
    """
    key = {"pid": "doc_id", "ps": "source", "pn": "size", "ph": "text_hash"}
    plan = saved(mix(docs).where("times > 0").select(*(F.col(c).alias(k) for k, c in key.items()), F.array("position", "position_again").alias("at")), "mix-plan")
    keyed = as_rows(docs).withColumn("n", word_count(F.col("row.text"))).withColumn("h", F.xxhash64("row.text"))
    same = F.col("row.doc_id").eqNullSafe(F.col("pid")) & F.col("row.source").eqNullSafe(F.col("ps")) & (F.col("n") == F.col("pn")) & (F.col("h") == F.col("ph"))
    copied = saved(plan.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1").drop("copies"), "mix-copies")
    if copied.take(1):
        # of copies one row stands for all, so that joining them with their takes doesn't multiply them
        apart = keyed.join(copied, same, "left_anti")
        one = keyed.join(copied, same, "left_semi").groupBy("row.doc_id", "row.source", "n", "h").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row", "n", "h")
        keyed = apart.unionByName(one)
    takes = keyed.join(plan, same).withColumn("pos", F.explode(F.filter("at", lambda x: x.isNotNull())))
    return takes.repartitionByRange("pos", "h").sortWithinPartitions("pos", "row.doc_id", "h").select("row.*")
