"""A named query is a function of (spark, sf_dir) with the SQL that an independent engine can run for it."""

from __future__ import annotations

from collections.abc import Callable

from ..sources.storage import table

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name; it gets a reader of tables: t("orders")."""

    def wrap(f: Callable) -> Callable:
        def run(spark, sf_dir):
            return f(lambda name: table(spark, sf_dir, name))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return wrap


def position_sql(seed: str, key: str) -> str:
    return f"(('0x' || substr(sha256('{seed}:' || CAST({key} AS VARCHAR)), 1, 12))::BIGINT / pow(2, 48))"


def draw_sql(seed: str, key: str) -> str:
    return f"(('0x' || substr(sha256('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT / 4294967295.0::DOUBLE)"
