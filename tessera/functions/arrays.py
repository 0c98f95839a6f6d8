"""Array and map operators as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def jaccard(a: Column, b: Column) -> Column:
    """Null when both are empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)).cast("double"), F.lit(0.0))


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading elements are equal."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    n = F.least(F.size(a), F.size(b))
    return F.coalesce(F.nullif(F.array_position(F.slice(same, 1, F.greatest(n, F.lit(0))), F.lit(False)), F.lit(0)) - 1, n.cast("long"))


def in_common(scores: Column, other: Column) -> Column:
    """A map filtered to the other map's keys."""
    return F.map_filter(scores, lambda k, _: F.map_contains_key(other, k))


def later_wins(first: Column, second: Column) -> Column:
    """Two maps merged; the second's values win. Needs no session setting."""
    rest = F.map_filter(first, lambda k, _: ~F.map_contains_key(second, k))
    return F.map_concat(rest, second)
