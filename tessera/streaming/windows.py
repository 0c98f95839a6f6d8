"""Event-time windows with watermarks, sessions, and exactly-once appends keyed by row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _marked(events: DataFrame, at: str, late: str) -> DataFrame:
    """A watermark if the frame streams; it wants a timestamp with a zone."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late) if events.isStreaming else events


def tumbling(events: DataFrame, at: str, width: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Counts and sums per window and key; rows later than the watermark are dropped when streaming."""
    source = _marked(events, at, late)
    w = F.window(F.col(at), width)
    return source.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, at: str, gap: str, key: str, late: str = "1 hour") -> DataFrame:
    source = _marked(events, at, late)
    w = F.session_window(F.col(at), gap)
    return source.groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def resumed(key: list[str], target: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that appends keys which aren't in the target yet, so a replayed batch adds nothing."""
    from ..sources.writers import append_ledger

    def write(batch: DataFrame, _: int) -> None:
        append_ledger(batch, target, key)

    return write


def first_fault(events: DataFrame, key: str, at: str, bad: str, most: int) -> DataFrame:
    """Keys with more than `most` bad rows, with the time of the first: a health poll as a running aggregate."""
    return events.groupBy(key).agg(F.count_if(F.expr(bad)).alias("faults"), F.min(F.when(F.expr(bad), F.col(at))).alias("first_at")).where(F.col("faults") > most)


def sliding(events: DataFrame, at: str, width: str, step: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Counts per overlapping window and key."""
    w = F.window(F.col(at), width, step)
    return _marked(events, at, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def stopped(events: DataFrame, key: str, at: str, bad: str, most: int, overdue: str, late: str = "0 seconds") -> DataFrame:
    """(key, reason, at) of a stream, once a key: `faults` when its bad rows exceed `most`, or `overdue` when the watermark passes its first row by
    the given time without that. State is three numbers a key; a key that was reported is ignored from then on."""
    limit = int(pd.Timedelta(overdue).total_seconds() * 1000)

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        faults, first, done = state.get if state.exists else (0, None, False)
        said = lambda reason, ms: pd.DataFrame({key: [k[0]], "reason": [reason], "at": [pd.Timestamp(ms, unit="ms", tz="UTC")]})
        if state.hasTimedOut:
            if not done:
                yield said("overdue", first + limit)
            state.update((faults, first, True))
            return
        for rows in parts:
            ms = rows["_ms"].astype("int64")
            first = int(ms.min()) if first is None else min(first, int(ms.min()))
            wrong = ms[rows["_bad"].astype(bool)].sort_values()
            if not done and faults + len(wrong) > most:
                done = True
                yield said("faults", int(wrong.iloc[most - faults]))
            faults += len(wrong)
        state.update((faults, first, done))
        if not done:
            state.setTimeoutTimestamp(max(first + limit, state.getCurrentWatermarkMs() + 1))

    source = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    source = source.select(key, at, F.unix_millis(at).alias("_ms"), F.coalesce(F.expr(bad), F.lit(False)).alias("_bad"))
    kind = dict(events.dtypes)[key]
    return source.groupBy(key).applyInPandasWithState(step, f"`{key}` {kind}, reason string, at timestamp", "faults long, first long, done boolean", "append", GroupStateTimeout.EventTimeTimeout)
