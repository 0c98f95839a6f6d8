"""Grouped counts, ledgers, deficits, pooled means and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hashing import hex_number


def histogram(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def long_histogram(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(group, field, value, n) for several columns in one pass."""
    entries = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns)))
    return df.select(group, entries.alias("e")).groupBy(group, "e.field", "e.value").agg(F.count("*").alias("n"))


def with_all(counts: DataFrame, names: list, key: str, value: str = "n") -> DataFrame:
    """Counts over a fixed list of keys, zeros included."""
    spark = counts.sparkSession
    fixed = spark.createDataFrame([(n,) for n in names], f"{key} string")
    return fixed.join(counts, key, "left").select(key, F.coalesce(value, F.lit(0)).alias(value))


def state_key(state: Column, reason: Column) -> Column:
    """state or state/reason, `?` for a missing state."""
    return F.concat_ws("/", F.coalesce(state, F.lit("?")), F.nullif(reason, F.lit("")))


def error_codes(df: DataFrame, code: Column, at: str) -> DataFrame:
    """Count and first time per label; missing and empty codes share one label and are summed."""
    label = F.coalesce(F.nullif(code, F.lit("")), F.lit("submission_failed"))
    return df.groupBy(label.alias("code")).agg(F.count("*").alias("n"), F.min(at).alias("first_at"))


def deficits(cells: DataFrame, have: DataFrame, on: list[str], need: str = "need", n: str = "n") -> DataFrame:
    """Cells that have fewer than they need, with what is missing."""
    joined = cells.join(have, on, "left").withColumn(n, F.coalesce(n, F.lit(0)))
    return joined.where(F.col(n) < F.col(need)).withColumn("missing", F.col(need) - F.col(n))


def pooled(df: DataFrame, group: list[str], weight: str, measures: list[str]) -> DataFrame:
    """Means weighted by pair counts, rounded to 4 places each."""
    total = F.nullif(F.sum(weight).cast("double"), F.lit(0.0))
    return df.groupBy(*group).agg(F.sum(weight).alias("pairs"), *(F.round(F.sum(F.col(m) * F.col(weight)) / total, 4).alias(m) for m in measures))


def clustered_means(attempts: DataFrame, arm: str, task: str, value: str) -> DataFrame:
    """Mean of task means per arm: a task with many attempts counts once."""
    per_task = attempts.groupBy(arm, task).agg(F.avg(value).alias("_m"))
    return per_task.groupBy(arm).agg(F.count("*").alias("tasks"), F.avg("_m").alias("mean"))


def paired_differences(attempts: DataFrame, arm: str, names: tuple[str, str], task: str, value: str) -> DataFrame:
    """(task, base, other, difference) where both arms have the task."""
    both = attempts.groupBy(task).pivot(arm, list(names)).agg(F.avg(value))
    base, other = (F.col(n) for n in names)
    return both.where(base.isNotNull() & other.isNotNull()).select(task, base.alias("base"), other.alias("other"), (other - base).alias("difference"))


#: Tasks that a bootstrap takes.
MOST_TASKS = 100_000


def bootstrap_interval(values: DataFrame, key: str, value: str, resamples: int, level: float, seed) -> DataFrame:
    """Percentile interval of the mean: resample b draws its i-th value by a hash of (seed, b, i), so reruns agree.

    `values` has one row a task; more than MOST_TASKS are refused, as every resample draws as many rows. Resamples are spread over tasks by exploding
    their numbers.
    """
    spark = values.sparkSession
    if values.limit(MOST_TASKS + 1).count() > MOST_TASKS:
        raise ValueError(f"more than {MOST_TASKS} tasks: aggregate them first")
    numbered = values.select((F.row_number().over(W.orderBy(key)) - 1).cast("bigint").alias("i"), F.col(value).alias("v"))
    n = numbered.count()
    draws = spark.range(resamples).withColumnRenamed("id", "b").withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(n - 1, 0)).cast("bigint"))))
    pick = hex_number(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("b").cast("string"), F.col("i").cast("string")), 256), 12) % F.lit(max(n, 1))
    means = draws.select("b", pick.alias("i")).join(numbered, "i").groupBy("b").agg(F.avg("v").alias("m"))
    tail = (1 - level) / 2
    low, high = int(tail * resamples), min(resamples - 1, int((1 - tail) * resamples))
    ranked = means.withColumn("r", F.row_number().over(W.orderBy("m", "b")) - 1)
    return ranked.agg(F.max(F.when(F.col("r") == low, F.col("m"))).alias("low"), F.max(F.when(F.col("r") == high, F.col("m"))).alias("high")).crossJoin(numbered.agg(F.avg("v").alias("mean"), F.count("*").alias("tasks")))


def turn_outcome(df: DataFrame, key: list[str], outcome: str) -> DataFrame:
    """failure over unknown over success; a turn without operations is a success."""
    rank = F.max(F.when(F.col(outcome) == "failure", 2).when(F.col(outcome) == "unknown", 1).otherwise(0))
    return df.groupBy(*key).agg(F.element_at(F.array(F.lit("success"), F.lit("unknown"), F.lit("failure")), F.coalesce(rank, F.lit(0)) + 1).alias("outcome"))


def verdicts(reviews: DataFrame, key: list[str], passed: str) -> DataFrame:
    """pass if all agree, fail if none does, else split."""
    every, some = F.bool_and(passed), F.bool_or(passed)
    return reviews.groupBy(*key).agg(F.when(every, "pass").when(some, "split").otherwise("fail").alias("verdict"))


def usage_tokens(document: Column) -> Column:
    """prompt_tokens if the key is there (even 0), else input_tokens, else 0."""
    return F.coalesce(F.get_json_object(document, "$.prompt_tokens").cast("bigint"), F.get_json_object(document, "$.input_tokens").cast("bigint"), F.lit(0).cast("bigint"))


def merged_observations(obs: DataFrame, key: str, at: str, fields: list[str], many: str | None = None) -> DataFrame:
    """One row an instance: first time kept, later non-null fields win, lists united."""
    aggs = [F.min(at).alias("first_at"), *(F.max_by(f, F.when(F.col(f).isNotNull(), F.col(at))).alias(f) for f in fields)]
    if many:
        aggs.append(F.array_sort(F.collect_set(many)).alias(many))
    return obs.groupBy(key).agg(*aggs)
