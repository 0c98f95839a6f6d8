"""Joins with checks: integrity, as-of, differences, completeness, leakage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    """A side of a join that must be there is missing."""


def missing(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows of left without a partner."""
    return left.join(right, on, "left_anti")


def kept(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    """Rows of left with a partner, once each."""
    return left.join(right, on, "left_semi")


def checked_join(left: DataFrame, right: DataFrame, on: list[str] | str, what: str = "rows") -> DataFrame:
    """An inner join that refuses to lose rows of left."""
    if missing(left, right, on).take(1):
        raise IntegrityError(f"{what} without a partner on {on}")
    return left.join(right, on)


def _same(on: list[str], a: str = "a", b: str = "b") -> Column:
    return reduce(lambda x, y: x & y, (F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in on))


def replaced(old: DataFrame, new: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Full outer by key: new values replace old ones, rows of either side stay."""
    joined = old.alias("a").join(new.withColumn("_new", F.lit(True)).alias("b"), _same(on), "full")
    pick = lambda c: F.when(F.col("b._new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
    return joined.select(*(pick(k).alias(k) for k in on), *(pick(v).alias(v) for v in values))


def overridden(base: DataFrame, decisions: DataFrame, on: str, value: str) -> DataFrame:
    """A decision's value where there is one, else the base's."""
    return base.join(decisions.select(on, F.col(value).alias("_d")), on, "left").withColumn(value, F.coalesce("_d", value)).drop("_d")


def differences(a: DataFrame, b: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Keys that only one side has or whose values differ: key, side, before and after as structs."""
    a, b = a.withColumn("_a", F.lit(True)), b.withColumn("_b", F.lit(True))
    joined = a.alias("a").join(b.alias("b"), _same(on), "full")
    changed = reduce(lambda x, y: x | y, (~F.col(f"a.{v}").eqNullSafe(F.col(f"b.{v}")) for v in values), F.lit(False))
    side = F.when(F.col("_b").isNull(), "removed").when(F.col("_a").isNull(), "added").when(changed, "changed")
    out = joined.select(*(F.when(F.col("_a"), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in on), side.alias("difference"), *(F.col(f"a.{v}").alias(f"before_{v}") for v in values), *(F.col(f"b.{v}").alias(f"after_{v}") for v in values))
    return out.where("difference is not null")


def completeness(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Keys expected but absent, and present but not expected."""
    less = expected.exceptAll(actual).withColumn("problem", F.lit("absent"))
    more = actual.exceptAll(expected).withColumn("problem", F.lit("unexpected"))
    return less.unionByName(more)


def duplicates(df: DataFrame, on: list[str]) -> DataFrame:
    """Keys that stand more than once."""
    return df.groupBy(*on).agg(F.count("*").alias("n")).where("n > 1")


def crossing(df: DataFrame, group: str, split: str) -> DataFrame:
    """Groups that lie in more than one split: no pair of splits is ever joined."""
    return df.groupBy(group).agg(F.countDistinct(split).alias("n_splits"), F.array_join(F.array_sort(F.collect_set(split)), ",").alias("splits")).where("n_splits > 1")


def asof(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, values: list[str], inclusive: bool = True) -> DataFrame:
    """Each left row with the latest right values at or before its time (before, if not inclusive), null where there are none.

    Union, one shuffle on the keys, and a running last value: rows of right sort before rows of left at equal times.
    """
    names = left.columns
    struct = F.struct(*(F.col(v).alias(v) for v in values))
    l_ = left.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(by)), F.col(left_time).alias("_t"), F.lit(1 if inclusive else 0).alias("_o"), F.struct(*names).alias("_row"))
    r_ = right.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(by)), F.col(right_time).alias("_t"), F.lit(0 if inclusive else 1).alias("_o"), struct.alias("_val"))
    both = l_.unionByName(r_, allowMissingColumns=True)
    w = W.partitionBy(*(f"_k{i}" for i in range(len(by)))).orderBy("_t", "_o").rowsBetween(W.unboundedPreceding, 0)
    seen = both.withColumn("_last", F.last("_val", ignorenulls=True).over(w)).where("_row is not null")
    return seen.select("_row.*", *(F.col(f"_last.{v}").alias(v) for v in values))


def score_pairs(first: DataFrame, second: DataFrame, on: list[str], scores: str = "scores") -> DataFrame:
    """Two raters' score maps matched by candidate: on, candidate, first, second."""
    a = first.select(*on, F.explode(scores).alias("candidate", "first"))
    b = second.select(*on, F.explode(scores).alias("candidate", "second"))
    return a.join(b, [*on, "candidate"])


def children(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """Each node with the number and sorted list of its children."""
    lists = nodes.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias(key)).agg(F.count("*").alias("n_children"), F.array_sort(F.collect_list(key)).alias("children"))
    return nodes.join(lists, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def arms(attempts: DataFrame, key: list[str], arm: str, names: list[str], value: str) -> DataFrame:
    """Mean value of each arm side by side."""
    return attempts.groupBy(*key).pivot(arm, names).agg(F.avg(value))


def interval_join(points: DataFrame, spans: DataFrame, by: list[str], at: str, start: str, end: str, width: float) -> DataFrame:
    """Points with the spans (start <= at < end) they lie in. Spans are posted under every stretch of `width` they touch, points under their own, so the join
    is an equality on stretches: choose a width near the usual span's, as a span costs a row for each stretch it touches."""
    stretch = lambda c: F.floor(F.col(c).cast("double") / F.lit(float(width)))
    posted = spans.where(F.col(end) > F.col(start)).withColumn("_stretch", F.explode(F.sequence(stretch(start), stretch(end))))
    return points.withColumn("_stretch", stretch(at)).join(posted, [*by, "_stretch"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_stretch")
