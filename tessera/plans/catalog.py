"""All named queries outside the text subpackage, and their SQL."""

from __future__ import annotations

from . import audits, campaign, counts, extensions, lookups, ordering, partitioning, predicates, scalars, storage  # noqa: F401
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
