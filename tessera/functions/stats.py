"""Statistics as columns and small frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: One-sided 95% normal quantile.
Z = 1.64485


def wilson(success: Column, n: Column, z: float = Z) -> tuple[Column, Column]:
    """Lower and upper Wilson bounds, clipped to [0, 1]; null for n = 0."""
    n = F.nullif(n.cast("double"), F.lit(0.0))
    p = success / n
    centre = (p + F.lit(z * z) / (2 * n)) / (1 + F.lit(z * z) / n)
    half = F.lit(z) * F.sqrt(p * (1 - p) / n + F.lit(z * z) / (4 * n * n)) / (1 + F.lit(z * z) / n)
    return F.when(n.isNotNull(), F.greatest(centre - half, F.lit(0.0))), F.when(n.isNotNull(), F.least(centre + half, F.lit(1.0)))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null for b = 0."""
    return a / F.nullif(b.cast("double"), F.lit(0.0))


def at_share(df: DataFrame, group: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Order statistics at index min(n - 1, int(share * n)) of each group, with count, total, min and max.

    The rank comes from a running count over distinct values, which partial aggregation has folded before any window sees them.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    over = W.partitionBy(*group)
    upto = F.sum("_n").over(over.orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    ranked = counts.withColumn("_upto", upto).withColumn("_all", F.sum("_n").over(over))
    picks = [F.min(F.when(F.col("_upto") > F.least(F.col("_all") - 1, F.floor(F.col("_all") * F.lit(s))), F.col(value))).alias(name) for name, s in shares.items()]
    return ranked.groupBy(*group).agg(F.sum("_n").alias("n"), F.sum(F.col(value) * F.col("_n")).alias("total"), F.min(value).alias("least"), *picks, F.max(value).alias("most"))


def weighted_kappa(pairs: DataFrame, a: str, b: str, group: list[str] = [], levels: int = 5) -> DataFrame:  # noqa: B006
    """Quadratic-weighted kappa of two ratings 0..levels-1: null without pairs or without expected disagreement; rounded to 4. Other ratings are
    refused, so the table of cells never has more than levels x levels rows a group."""
    fits = lambda c: F.col(c).between(0, levels - 1) & (F.col(c) == F.floor(F.col(c)))
    if pairs.where(~fits(a) | ~fits(b)).take(1):
        raise ValueError(f"ratings must be whole numbers from 0 to {levels - 1}")
    cells = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*group, a, b).agg(F.count("*").alias("o"))
    rows = cells.groupBy(*group, F.col(a).alias("i")).agg(F.sum("o").alias("r"))
    cols = cells.groupBy(*group, F.col(b).alias("j")).agg(F.sum("o").alias("c"))
    weight = lambda i, j: F.pow((F.col(i) - F.col(j)) / F.lit(float(levels - 1)), 2)
    seen = cells.groupBy(*group).agg(F.sum(weight(a, b) * F.col("o")).alias("seen"), F.sum("o").alias("n"))
    both = rows.join(cols, group) if group else rows.crossJoin(cols)  # levels x levels rows a group
    by_chance = both.groupBy(*group).agg(F.sum(weight("i", "j") * F.col("r") * F.col("c")).alias("chance"))
    joined = seen.join(by_chance, group) if group else seen.crossJoin(by_chance)
    return joined.select(*group, F.col("n").alias("pairs"), F.round(1 - F.col("seen") / F.nullif(F.col("chance") / F.col("n"), F.lit(0.0)), 4).alias("kappa"))
