"""Deterministic draws, positions and ids from SHA digests, as columns."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(*parts) -> Column:
    return F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))


def hex_number(digest: Column, digits: int) -> Column:
    """The first hex digits of a digest as a bigint."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def position(seed, key: Column) -> Column:
    """A place in [0, 1): 48 bits of SHA-256 over seed:key."""
    return hex_number(F.sha2(_text(seed, key), 256), 12).cast("double") / F.lit(float(2**48))


def closed_draw(seed, key: Column) -> Column:
    """A draw in [0, 1], both ends included: 32 bits over 0xFFFFFFFF."""
    return hex_number(F.sha2(_text(seed, key), 256), 8).cast("double") / F.lit(float(2**32 - 1))


def order_seed(key: Column) -> Column:
    """A bigint to order by, from the first 8 hex digits."""
    return hex_number(F.sha2(key.cast("string"), 256), 8)


def short_id(*parts, digits: int = 16, newer: bool = False) -> Column:
    """A short id over lines: SHA-1 by default, SHA-256 if newer."""
    joined = F.concat_ws("\n", *parts)
    return F.substring(F.sha2(joined, 256) if newer else F.sha1(joined), 1, digits)


def canonical(value) -> str:
    """JSON with sorted keys, no blanks, non-ASCII kept and no NaN."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def canonical_digest(document: Column) -> Column:
    """SHA-256 of the canonical form of a JSON text; null where it isn't JSON. Python, because engines rewrite numbers."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return hashlib.sha256(canonical(json.loads(text)).encode("utf-8")).hexdigest()
            except (TypeError, ValueError):
                return None

        return texts.map(one)

    return run(document)
