"""Filters, predicates and first-match classifications."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import closed_draw
from ..functions.text import authorized, basename, dirname, first_sentence, is_prose, mentions_identifier, names_pattern, parents, path_mentions, tokens, without_prefix


def length_gate(df: DataFrame, text: str, low: int = 12, high: int = 2400) -> DataFrame:
    return df.where(F.length(text).between(low, high))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that holds, null if none does. A rule that is null doesn't hold."""
    out = None
    for condition, name in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return out


def path_gate(prompts: DataFrame, files: DataFrame, key: str, text: str, new_files: bool = False) -> DataFrame:
    """(key, mentions, all_known): a prompt passes if every path-like token is a known path, basename or path suffix, or, with
    `new_files`, a file to create at the top or in a folder there is. `files` has a column path."""
    found = prompts.select(key, F.explode(F.array_distinct(path_mentions(F.col(text)))).alias("token"))
    parts = F.split("path", "/")
    known = files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))).alias("token")).distinct()
    hits = found.join(known.withColumn("known", F.lit(True)), "token", "left")
    ok = F.coalesce("known", F.lit(False))
    if new_files:
        folders = files.where(F.size(parts) > 1).select(F.explode(parents(F.col("path"))).alias("folder")).distinct().withColumn("there", F.lit(True))
        hits = hits.withColumn("folder", dirname(F.col("token"))).join(folders, "folder", "left")
        ok = ok | ~F.col("token").contains("/") | F.coalesce("there", F.lit(False))
    hits = hits.groupBy(key).agg(F.count("*").alias("mentions"), F.bool_and(ok).alias("ok"))
    return prompts.select(key).join(hits, key, "left").select(key, F.coalesce("mentions", F.lit(0)).alias("mentions"), F.coalesce("ok", F.lit(True)).alias("all_known"))


def doc_pairs(units: DataFrame, least: int = 6, words: int = 3) -> DataFrame:
    """Requests from the leading comments of units (repo, file, line, symbol, doc): the comment's first sentence without the unit's name, where it
    reads as prose of at least `least` tokens and names neither the unit nor its file, with a query of its first longer words."""
    doc = F.regexp_replace(F.col("doc"), r"^(?U)\s+|(?U)\s+$", "")
    task = without_prefix(first_sentence(doc), F.col("symbol"))
    out = units.where(doc != "").withColumn("task", task)
    out = out.where(is_prose(F.col("task")) & (F.size(tokens(F.col("task"))) >= least) & ~mentions_identifier(F.col("task"), F.col("symbol"), F.col("file")))
    longer = F.filter(F.regexp_extract_all(F.lower("task"), F.lit("([a-z][a-z0-9]+)"), 1), lambda w: F.length(w) > 3)
    return out.select("repo", "file", "line", "symbol", "task", F.array_join(F.slice(longer, 1, words), " ").alias("query"), F.lit("en").alias("lang"), F.lit("docs").alias("source"))


def naming(texts: DataFrame, text: str, names: list[str]) -> DataFrame:
    """Adds the list of given names that a text names. The list is configuration, so it becomes one expression."""
    hits = F.array(*(F.when(F.col(text).rlike(names_pattern(n)), F.lit(n)) for n in names))
    return texts.withColumn("named", F.array_compact(hits))


def mixed(base: DataFrame, families: DataFrame, fraction: float, seed, family: str) -> DataFrame:
    """All base rows and the seeded share of whole families."""
    return base.unionByName(families.where(closed_draw(seed, F.col(family)) < fraction))


def failed_bars(bars: DataFrame, measures: DataFrame, on: str = "name") -> DataFrame:
    """Bars (name, at_least) that a measure (name, value) misses; a measure that isn't there is a miss."""
    return bars.join(measures, on, "left").where(F.col("value").isNull() | (F.col("value") < F.col("at_least"))).select(on, "at_least", "value")


def failed_controls(controls: DataFrame, scores: DataFrame, on: list[str], low: int = 0, high: int = 4) -> DataFrame:
    """Controls whose score is missing or outside at_least..at_most."""
    ok = F.col("score").between(F.coalesce("at_least", F.lit(low)), F.coalesce("at_most", F.lit(high)))
    return controls.join(scores, on, "left").where(~F.coalesce(ok, F.lit(False)))


def overlay(bound: DataFrame, calibrated: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Calibrated values over bound ones; keys of either side stay."""
    a, b = bound.alias("a"), calibrated.alias("b")
    same = reduce(lambda x, y: x & y, (F.col(f"a.{k}") == F.col(f"b.{k}") for k in on))
    return a.join(b, same, "full").select(*(F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in on), *(F.coalesce(F.col(f"b.{v}"), F.col(f"a.{v}")).alias(v) for v in values))


def item_states(decisions: DataFrame, item: str) -> DataFrame:
    """labelled: all decisions human and settled; skipped: any skip; automatic: any automatic; else open."""
    state = F.when(F.bool_and(F.col("kind") == "human"), "labelled").when(F.bool_or(F.col("kind") == "skip"), "skipped").when(F.bool_or(F.col("kind") == "automatic"), "automatic").otherwise("open")
    return decisions.groupBy(item).agg(state.alias("state"))


def reference_appended(prompts: DataFrame, files: DataFrame, key: str, text: str, drawn: Column, seed, share: float) -> DataFrame:
    """Adds `reference` to a seeded share of prompts, null for the rest: the first file (`path`) that the prompt mentions by path or, else, by
    basename, else the drawn one."""
    chosen = prompts.where(closed_draw(seed, F.col(key)) < share)
    found = chosen.select(key, F.posexplode(path_mentions(F.col(text))).alias("at", "token"))
    # of files with one basename the last by path counts
    names = files.select("path", basename(F.col("path")).alias("token")).groupBy("token").agg(F.max("path").alias("named"))
    paths = files.select(F.col("path").alias("token"), F.col("path").alias("exact")).distinct()
    hits = found.join(paths, "token", "left").join(names, "token", "left").withColumn("hit", F.coalesce("exact", "named")).where("hit is not null")
    first = hits.groupBy(key).agg(F.min_by("hit", "at").alias("mentioned"))
    picked = chosen.join(first, key, "left").select(key, F.coalesce(F.col("mentioned"), drawn).alias("reference"))
    return prompts.join(picked, key, "left")


def of_partition(rows: DataFrame, partition: str, path: str = "meta.split") -> DataFrame:
    """Rows whose nested metadata name the partition; rows without any don't."""
    return rows.where(F.col(path) == partition)


def effect_receipt(effects: DataFrame, sessions: DataFrame, submissions: DataFrame, by: str) -> DataFrame:
    """(by, unauthorized, interventions): effects (by, session, path, project, roots) outside the allowed roots, and effects of sessions (by, session)
    that aren't the task's plus the gap between submissions made and expected (by, made, expected)."""
    known = sessions.select(by, "session").distinct().withColumn("known", F.lit(True))
    judged = effects.join(known, [by, "session"], "left")
    counted = judged.groupBy(by).agg(F.count_if(~authorized(F.col("path"), F.col("project"), F.col("roots"))).alias("unauthorized"), F.count_if(F.col("known").isNull()).alias("strange"))
    out = submissions.select(by, F.abs(F.col("made") - F.col("expected")).alias("gap")).join(counted, by, "left")
    zero = F.lit(0).cast("long")
    return out.select(by, F.coalesce("unauthorized", zero).alias("unauthorized"), (F.col("gap") + F.coalesce("strange", zero)).alias("interventions"))


__all__ = ["basename", "doc_pairs", "effect_receipt", "failed_bars", "failed_controls", "first_reason", "item_states", "length_gate", "mixed", "naming", "of_partition", "overlay", "path_gate", "reference_appended"]
