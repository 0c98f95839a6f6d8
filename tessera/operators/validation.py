"""Constraint queries: each returns violations, and an empty result is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import first_sentence  # noqa: F401
from .joins import crossing, missing


def row_violations(df: DataFrame, key: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """(key, violation): the first rule, in order, that a row breaks. A rule that is null counts as broken."""
    case = None
    for name, rule in rules:
        broken = ~F.coalesce(rule, F.lit(False))
        case = F.when(broken, name) if case is None else case.when(broken, name)
    return df.select(*key, case.alias("violation")).where("violation is not null")


def required_keys(df: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """Rows whose required fields are null or empty, with the names of those fields."""
    gaps = F.array_compact(F.array(*(F.when(F.col(n).isNull() | (F.col(n).cast("string") == ""), F.lit(n)) for n in names)))
    return df.select(*key, gaps.alias("missing")).where(F.size("missing") > 0)


def rebound(df: DataFrame, key: list[str], content: Column, digest: str) -> DataFrame:
    """Rows whose content doesn't have the recorded digest."""
    return df.where(~F.sha2(content, 256).eqNullSafe(F.col(digest))).select(*key)


def at_most_one(df: DataFrame, column: str) -> DataFrame:
    """One row with the number of values if there is more than one."""
    return df.agg(F.countDistinct(column).alias("n")).where("n > 1")


def unlisted(rows: DataFrame, tasks: DataFrame, on: str) -> DataFrame:
    return missing(rows, tasks, on).select(on).distinct()


def wrong_partition(rows: DataFrame, assignment: DataFrame, on: str, held: str = "split", expected: str = "partition") -> DataFrame:
    """Rows that lie in another partition than their assignment says."""
    return rows.join(assignment.select(on, expected), on).where(~F.col(held).eqNullSafe(F.col(expected))).select(on, held, expected)


def recounted(claims: DataFrame, rows: DataFrame, name: str, value: str, group: str) -> DataFrame:
    """Claims (name, value) that a recount of rows by group doesn't bear out."""
    counts = rows.groupBy(F.col(group).alias(name)).agg(F.count("*").alias("_found"))
    joined = claims.join(counts, name, "full")
    return joined.where(~F.coalesce(value, F.lit(0)).eqNullSafe(F.coalesce("_found", F.lit(0)))).select(name, F.col(value).alias("claimed"), F.coalesce("_found", F.lit(0)).alias("found"))


def release_audit(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) over all checks, zeros included."""
    parts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def bindings(sessions: DataFrame, tasks: DataFrame, on: str, facts: list[str]) -> DataFrame:
    """Sessions whose facts differ from their task's, or whose task isn't there."""
    a, b = sessions.alias("a"), tasks.withColumn("_there", F.lit(True)).alias("b")
    same = reduce(lambda x, y: x & y, (F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")) for f in facts))
    joined = a.join(b, on, "left")
    return joined.where(F.col("_there").isNull() | ~same).select("a.*", F.when(F.col("_there").isNull(), "unknown").otherwise("differs").alias("violation"))


def qualified(controls: DataFrame, by: list[str], right: str) -> DataFrame:
    """Reviewers and whether every one of their controls is right."""
    return controls.groupBy(*by).agg(F.bool_and(F.coalesce(right, F.lit(False))).alias("qualified"), F.count("*").alias("controls"))


def admitted(turns: DataFrame, by: list[str], order: list[str], exclusion: Column, failed: Column) -> DataFrame:
    """Admission of ordered turns: category excluded:<reason>, recovery (after an earlier failure, excluded ones too) or plain; first admitted marked."""
    w = W.partitionBy(*by).orderBy(*order)
    earlier = F.coalesce(F.max(failed.cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)) == 1, F.lit(False))
    out = turns.withColumn("_x", exclusion)
    category = F.when(F.col("_x").isNotNull(), F.concat(F.lit("excluded:"), F.col("_x"))).when(earlier, "recovery").otherwise("plain")
    out = out.withColumn("category", category)
    place = F.sum(F.col("_x").isNull().cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))
    return out.withColumn("first_admitted", F.col("_x").isNull() & (place == 1)).drop("_x")


def one_split(df: DataFrame, group: str, split: str) -> DataFrame:
    return crossing(df, group, split)


def source_issues(rows: DataFrame, sources: DataFrame, exported: DataFrame) -> DataFrame:
    """(row, issue) of rows (row, source, stated lineage or null) whose source isn't there, that the export doesn't hold, or that state another lineage than
    their source (source, lineage); the first of these."""
    known = sources.select("source", "lineage", F.lit(True).alias("_known"))
    held = exported.select("row").distinct().withColumn("_held", F.lit(True))
    joined = rows.join(known, "source", "left").join(held, "row", "left")
    issue = F.when(F.col("_known").isNull(), "source_unknown").when(F.col("_held").isNull(), "row_not_exported").when(F.col("stated") != F.col("lineage"), "lineage_differs")
    return joined.select("row", issue.alias("issue")).where("issue is not null")


def registration(roots: DataFrame) -> DataFrame:
    """(violation, subject) of registered roots (id, session, task, frozen): ids that stand twice, sessions of more than one task, banks that aren't frozen."""
    twice = roots.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated_id").alias("violation"), F.col("id").cast("string").alias("subject"))
    many = roots.groupBy("session").agg(F.countDistinct("task").alias("n")).where("n > 1").select(F.lit("session_of_many_tasks").alias("violation"), F.col("session").cast("string").alias("subject"))
    open_ = roots.where(~F.coalesce("frozen", F.lit(False))).select(F.lit("unfrozen_bank").alias("violation"), F.col("id").cast("string").alias("subject"))
    return twice.unionByName(many).unionByName(open_)
