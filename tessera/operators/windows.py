"""Order-sensitive operators: first and last per key, packing, lanes, quotas, running flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per(df: DataFrame, by: list[str], order: list[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows of each key. Spark prunes groups before the shuffle with a limit of k a key."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def earlier_failure(df: DataFrame, by: list[str], order: list[str], failed: Column) -> Column:
    """Whether an earlier row of the key failed; false for the first."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.max(failed.cast("int")).over(w) == 1, F.lit(False))


def packed(df: DataFrame, by: list[str], order: list[Column], size: Column | int) -> DataFrame:
    """Consecutive shards of at most `size` rows of equal keys; shards number through all keys of the first."""
    w = W.partitionBy(*by).orderBy(*order)
    out = df.withColumn("shard_in_key", F.floor((F.row_number().over(w) - 1) / (F.lit(size) if isinstance(size, int) else size)).cast("int"))
    return out.withColumn("shard", F.dense_rank().over(W.partitionBy(by[0]).orderBy(*by[1:], "shard_in_key")))


def lanes(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """Round robin over n lanes."""
    return df.withColumn("lane", F.pmod(F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1, F.lit(n)))


def asked_quota(df: DataFrame, by: list[str], order: list[str], quotas: Column) -> DataFrame:
    """Rows up to a quota of each key, in order."""
    return df.withColumn("place", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("place") <= quotas)


def accepted_up_to(df: DataFrame, by: list[str], order: list[str], accepted: Column, count: int) -> DataFrame:
    """Rows of each key up to and with the count-th accepted one: what a producer that stops early has looked at."""
    w = W.partitionBy(*by).orderBy(*order)
    seen = F.coalesce(F.sum(accepted.cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("accepted", accepted).withColumn("accepted_before", seen).where(F.col("accepted_before") < count)


def check_routes(weights: list[tuple[str, float]], known: set[str]) -> None:
    """Routes must name known choices, each once, with weights of 0 or more that aren't all 0."""
    names = [n for n, _ in weights]
    if set(names) - known or len(set(names)) < len(names):
        raise ValueError(f"routes must name known choices once: {', '.join(sorted(n for n in set(names) if n not in known or names.count(n) > 1))}")
    if not weights or any(not isinstance(w, (int, float)) or isinstance(w, bool) or w < 0 for _, w in weights) or not sum(w for _, w in weights):
        raise ValueError("weights must be 0 or more, and not all 0")


def weighted_choice(df: DataFrame, draw: Column, weights: list[tuple[str, float]]) -> Column:
    """The name whose cumulative weight first exceeds the draw in [0, 1)."""
    total, upto, out = sum(w for _, w in weights), 0.0, None
    for name, w in weights:
        upto += w / total
        out = F.when(draw < upto, name) if out is None else out.when(draw < upto, name)
    return out.otherwise(weights[-1][0])
