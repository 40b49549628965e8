"""Portable, seeded unit hash.

``unit_hash(key, seed)`` is the first 15 hex digits of
``md5(key || '|' || seed)`` read as a non-negative 60-bit integer. DuckDB
computes the same value as
``CAST('0x' || substr(md5(CAST(key AS VARCHAR) || '|' || 'seed'), 1, 15) AS BIGINT)``,
so a split drawn in Spark can be checked outside it. The value is uniform on
[0, 2^60), so comparisons against ``p * 2^60`` are Bernoulli(p) draws that
repeat exactly for the same seed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timecols import col_of

HASH_BITS = 60
HASH_SPACE = 1 << HASH_BITS


def unit_hash(key: str | Column, seed: int | str) -> Column:
    s = F.concat(col_of(key).cast("string"), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("bigint")


def hash_threshold(p: float) -> int:
    """Integer threshold t with P(unit_hash < t) = p."""
    p = min(max(float(p), 0.0), 1.0)
    return int(p * HASH_SPACE)


def duck_unit_hash(key_sql: str, seed: int | str) -> str:
    """The same hash as DuckDB SQL text (used by the oracle strings)."""
    return (f"CAST('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{seed}'), 1, 15)"
            f" AS BIGINT)")
