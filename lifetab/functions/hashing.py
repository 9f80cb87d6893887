"""Deterministic, seed-able hashes built from Spark SQL functions.

Randomness in the library never comes from ``rand()`` over an unordered
input (its value depends on partitioning and is redrawn on task retry).
Every random choice is a pure function of (seed, row key), so a rerun, a
retried task or a different cluster size gives the same rows.  The md5 form
is reproducible outside Spark (DuckDB:
``('0x' || substr(md5(s), 1, 15))::BIGINT``), which the SQL oracles use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
HASH_SCALE = float(1 << HASH_BITS)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_string(seed, *cols) -> Column:
    """'seed|k1|k2...' with keys cast to string (integer and string keys)."""
    parts = [F.lit(str(seed))] + [_as_col(c).cast("string") for c in cols]
    return F.concat_ws("|", *parts)


def seeded_hash(seed, *cols) -> Column:
    """Non-negative 60-bit integer hash of (seed, cols)."""
    return F.conv(F.substring(F.md5(key_string(seed, *cols)), 1, 15), 16, 10).cast("bigint")


def seeded_uniform(seed, *cols) -> Column:
    """Uniform double in [0, 1) from ``seeded_hash``."""
    return seeded_hash(seed, *cols).cast("double") / F.lit(HASH_SCALE)


def hash_bucket(hash_col: Column, n_buckets_log2: int) -> Column:
    """Top bits of a 60-bit hash: a bucket id monotone in the hash."""
    return F.shiftright(hash_col, HASH_BITS - n_buckets_log2).cast("int")


def sql_seeded_hash(seed, *exprs: str) -> str:
    """DuckDB text of ``seeded_hash`` for the oracle queries."""
    inner = ", ".join([f"'{seed}'"] + [f"CAST({e} AS VARCHAR)" for e in exprs])
    return f"('0x' || substr(md5(concat_ws('|', {inner})), 1, 15))::BIGINT"
