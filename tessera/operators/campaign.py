"""Operators of a collection campaign: admission, staleness, quotas, ledgers, signatures, scaled configurations."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import canonical
from .filters import first_reason
from .joins import IntegrityError, asof
from .windows import first_per


def call_reason() -> Column:
    """Why a call's record can't supervise, null if it can; the first reason wins."""
    c = F.col
    return first_reason(
        (~c("offered"), "unoffered_call"),
        (~c("recorded"), "unrecorded_call"),
        (c("settlement") != "settled", "unsettled_operation"),
        (c("effect_state") == "unknown", "unknown_effects"),
        (c("replays_unknown_effects"), "replay_after_unknown_effects"),
        (~c("invoked") & (c("semantic_outcome") == "failure"), "authorization_refusal"),
    )


def first_reason_of(calls: Column, reason) -> Column:
    """The first reason among an array of calls; `reason` makes one of a call."""
    return F.get(F.filter(F.transform(calls, reason), lambda x: x.isNotNull()), 0)


def stale_verifications(moments: DataFrame, operations: DataFrame, by: str, key: str) -> DataFrame:
    """(key, stale) for moments (by, key, at): verification had passed by then, but not on the last revision by then.

    operations: by, started_at, order (a tie of started_at goes to the later one, a tie of both to the greater revision), source_revision, source_verdict. The passed
    revisions so far are known from the time at which each first passed, so none are collected.
    """
    revisions = operations.where("source_revision is not null").select(by, F.struct("started_at", "order", "source_revision").alias("started"), "source_revision")
    no_revision = F.lit(None).cast(operations.schema["source_revision"].dataType)
    known = moments.withColumn("until", F.struct(F.col("at").alias("started_at"), F.lit(2**62).alias("order"), no_revision.alias("source_revision")))
    last = asof(known, revisions, [by], "until", "started", ["source_revision"])
    passed = operations.where("source_verdict = 'passed'")
    any_at = passed.groupBy(by).agg(F.min("started_at").alias("any_at"))
    first_at = passed.where("source_revision is not null").groupBy(by, "source_revision").agg(F.min("started_at").alias("first_at"))
    joined = last.join(any_at, by, "left").join(first_at, [by, "source_revision"], "left")
    ever = F.coalesce(F.col("any_at") <= F.col("at"), F.lit(False))
    fresh = F.coalesce(F.col("first_at") <= F.col("at"), F.lit(False))
    return joined.select(key, (ever & F.col("source_revision").isNotNull() & ~fresh).alias("stale"))


def admission(turns: DataFrame, calls: DataFrame, operations: DataFrame, witnessed: DataFrame) -> DataFrame:
    """(episode, session, turn, eligibility, category, reason, outcome): the whole admission sequence of an episode's turns.

    turns: episode, session, turn, settled_at, committed, host_exclusion, closeout_reason; calls: turn, position, the columns of ``call_reason``,
    source_verdict, source_revision; operations: episode, started_at, order, source_revision, source_verdict; witnessed: episodes whose diagnostic
    check passed. Turns the host excluded stay out; of the rest in the order they settled, a failure marks its session, and later turns with
    calls of that session are recoveries, whether it was admitted or not. Operations of one started_at and order follow each other by revision, and of
    the reasons at one position the least by name counts, so reruns agree.
    """
    first = first_per(operations.where("source_revision is not null"), ["episode"], [F.col("started_at"), F.col("order"), F.col("source_revision")]).select("episode", F.col("source_revision").alias("initial"))
    base = turns.join(first, "episode", "left").join(witnessed.select("episode").distinct().withColumn("witness", F.lit(True)), "episode", "left")
    with_initial = calls.join(base.select("turn", "initial"), "turn")
    reproduced = (F.col("source_verdict") == "failed") & (F.col("source_revision") == F.col("initial"))
    outcome = F.max(F.when(F.col("semantic_outcome") == "failure", 2).when(F.coalesce("semantic_outcome", F.lit("unknown")) == "unknown", 1).otherwise(0))
    per_turn = with_initial.withColumn("why", call_reason()).groupBy("turn").agg(
        F.min(F.when(F.col("why").isNotNull(), F.struct("position", "why")))["why"].alias("call_reason"), outcome.alias("worst"), F.bool_or(F.coalesce(reproduced, F.lit(False))).alias("reproduced")
    )
    stale = stale_verifications(turns.select("episode", "turn", F.col("settled_at").alias("at")), operations, "episode", "turn")
    out = base.join(per_turn, "turn", "left").join(stale, "turn", "left")
    out = out.withColumn("outcome", F.when(F.col("host_exclusion").isNull(), F.when(F.col("worst") == 2, "failure").when(F.col("worst") == 1, "unknown").otherwise("success")))
    # the first failure of a session marks it for all turns that settle later
    settled = F.struct("settled_at", "turn")
    failed = out.where("outcome = 'failure'").groupBy("episode", "session").agg(F.min(settled).alias("failed_at"))
    out = out.join(failed, ["episode", "session"], "left")
    called = F.col("worst").isNotNull()
    diagnosed = F.coalesce("witness", F.lit(False)) & F.col("reproduced")
    reason = first_reason(
        (F.col("host_exclusion").isNotNull(), "host_excluded"),
        (called & F.col("call_reason").isNotNull(), "call"),
        (called & (F.col("outcome") == "failure") & ~diagnosed, "failure_without_witness"),
        (called & (F.col("outcome") == "unknown"), "unknown_outcome"),
        (~called & ~F.col("committed"), "uncommitted_reply"),
        (~called & F.col("closeout_reason").isNotNull(), "closeout"),
        (~called & F.col("stale"), "stale_verification"),
    )
    out = out.withColumn("reason", F.when(reason == "call", F.col("call_reason")).when(reason == "closeout", F.col("closeout_reason")).otherwise(reason))
    category = F.when(~called, "closeout").when(F.col("outcome") == "failure", "diagnostic").when(F.coalesce(F.col("failed_at") < settled, F.lit(False)), "recovery").otherwise("ordinary")
    eligible = F.col("reason").isNull()
    return out.select("episode", "session", "turn", F.when(eligible, "eligible").otherwise("excluded").alias("eligibility"), F.when(eligible, category).alias("category"), "reason", "outcome")


def quota_collection(attempts: DataFrame, minimum: int, groups_per_focus: int, focuses: list[str], most: int = 3) -> DataFrame:
    """The attempts a greedy collection makes. attempts: partition, place (order of tasks), task, focus, grp, attempt (from 0), success.

    A partition's tasks are tried in order, each up to `most` times until one succeeds; collection stops before the first task at which the partition has
    `minimum` successes and every focus has successes in `groups_per_focus` groups. Whether it has stopped depends only on the place at which the last of these
    is reached, so no running state is needed. Adds admitted.
    """
    tried = attempts.where(F.col("attempt") < most)
    first = tried.groupBy("partition", "place", "task", "focus", "grp").agg(F.min(F.when(F.col("success"), F.col("attempt"))).alias("won"))
    won = first.where("won is not null")
    enough = first_per(won.select("partition", "place"), ["partition"], [F.col("place")], k=minimum, rank="nth").where(F.col("nth") == minimum).select("partition", F.col("place").alias("enough"))
    groups = won.groupBy("partition", "focus", "grp").agg(F.min("place").alias("place"))
    covered = first_per(groups.where(F.col("focus").isin(*focuses)), ["partition", "focus"], [F.col("place"), F.col("grp")], k=groups_per_focus, rank="nth").where(F.col("nth") == groups_per_focus)
    covered = covered.groupBy("partition").agg(F.max("place").alias("covered"), F.count("*").alias("n")).where(F.col("n") == len(focuses)).select("partition", "covered")
    stop = enough.join(covered, "partition").select("partition", F.greatest("enough", "covered").alias("stop"))
    kept = tried.join(first.select("partition", "task", "won"), ["partition", "task"]).join(stop, "partition", "left")
    kept = kept.where((F.col("stop").isNull() | (F.col("place") <= F.col("stop"))) & (F.col("won").isNull() | (F.col("attempt") <= F.col("won"))))
    return kept.select("partition", "place", "task", "focus", "grp", "attempt", F.coalesce(F.col("attempt") == F.col("won"), F.lit(False)).alias("admitted"))


def ledger_faults(decisions: DataFrame, probes: DataFrame, publications: DataFrame, bundles: list[str]) -> DataFrame:
    """(student, fault): publications that don't match the decision. decisions: student, publish; probes and publications: student, bundle, manifest_sha256.

    A published student needs every bundle, no other and no manifest but the one that was probed; an unpublished one must have none.
    """
    expected = decisions.select("student", "publish", F.explode(F.array(*map(F.lit, bundles))).alias("bundle"))
    made = publications.withColumnRenamed("manifest_sha256", "made").withColumn("there", F.lit(True))
    probed = probes.select("student", "bundle", F.col("manifest_sha256").alias("probed"))
    every = expected.join(made, ["student", "bundle"], "full").join(probed, ["student", "bundle"], "left").drop("publish").join(decisions, "student", "left")
    missing, strange = F.col("there").isNull(), ~F.col("bundle").isin(*bundles)
    published = F.coalesce("publish", F.lit(False))
    found = every.groupBy("student").agg(
        F.bool_or(published).alias("published"), F.bool_or(F.coalesce("there", F.lit(False))).alias("any"), F.bool_or(missing | strange).alias("incomplete"),
        F.bool_or(~F.col("made").eqNullSafe(F.col("probed")) & ~missing).alias("unprobed"),
    )
    fault = first_reason((F.col("published") & F.col("incomplete"), "publication_incomplete"), (F.col("published") & F.col("unprobed"), "publication_not_probed"), (~F.col("published") & F.col("any"), "publication_not_decided"))
    return found.select("student", fault.alias("fault")).where("fault is not null")


def scaled(archetypes: DataFrame, share: float | None = None, cap: int | None = None, chosen: list[str] = [], follow_up_rate: float | None = None, follow_ups: int | None = None) -> DataFrame:  # noqa: B006
    """Archetypes (id, per_workspace, follow_up_rate, max_follow_ups) at a smaller volume: a share keeps the mix, one task at least each; a cap
    flattens it; chosen ids stay alone, unknown ones are refused."""
    if share is not None and not 0 < share <= 1:
        raise ValueError("a share lies above 0 and is at most 1")
    known = {r["id"] for r in archetypes.select("id").collect()} if chosen else set()  # configuration
    if unknown := sorted(set(chosen) - known):
        raise ValueError(f"unknown archetypes: {', '.join(unknown)}")
    n = F.col("per_workspace")
    if share is not None:
        n = F.greatest(F.lit(1), F.rint(n * F.lit(share)).cast("int"))
    if cap:
        n = F.least(n, F.lit(cap))
    out = archetypes.withColumn("per_workspace", n.cast("int"))
    out = out.withColumn("follow_up_rate", F.lit(float(follow_up_rate))) if follow_up_rate is not None else out
    out = out.withColumn("max_follow_ups", F.lit(int(follow_ups))) if follow_ups is not None else out
    return out.where(F.col("id").isin(*chosen)) if chosen else out


def _digest(value) -> str:
    return hashlib.sha256(canonical(value).encode("utf-8")).hexdigest()


def bound(values: dict[str, str], artifact: str, depends: dict[str, tuple[str, ...]]) -> dict:
    """The identities an artifact depends on, and their digest; unknown artifacts, missing and empty values are refused."""
    if empty := sorted(k for k, v in values.items() if not v or not isinstance(v, str)):
        raise ValueError(f"invalid values: {', '.join(empty)}")
    if artifact not in depends:
        raise ValueError(f"unknown artifact: {artifact}")
    if missing := [k for k in depends[artifact] if k not in values]:
        raise ValueError(f"{artifact} lacks {', '.join(missing)}")
    held = {k: values[k] for k in depends[artifact]}
    return {"artifact": artifact, "identities": held, "sha256": _digest(held)}


def still_bound(binding: dict, values: dict[str, str], artifact: str, depends: dict[str, tuple[str, ...]]) -> bool:
    """Whether an artifact bound earlier still matches these identities."""
    return binding.get("artifact") == artifact and bound(values, artifact, depends)["sha256"] == binding.get("sha256")


def run_signature(inputs: DataFrame, facts: dict) -> dict:
    """What a run's labels depend on: the facts, and a digest of the inputs that neither their order nor their partitions change: the number of rows and
    the sums of four parts of each row's SHA-256."""
    row = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(inputs.columns))), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.sum(F.conv(F.substring(row, 16 * k + 1, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    sums = inputs.agg(F.count("*").cast("string"), *(part(k) for k in range(4))).first()
    return {**facts, "inputs_sha256": hashlib.sha256(",".join(str(x or 0) for x in sums).encode()).hexdigest()}


def check_signature(held: dict | None, now: dict) -> dict:
    """The signature to go on under; labels of a run under another one are refused, with the names that differ."""
    if held is not None and held != now:
        raise IntegrityError("another run's labels: " + ", ".join(sorted(k for k in held.keys() | now.keys() if held.get(k) != now.get(k))))
    return now
