"""Deterministic per-row random numbers.

Spark's ``rand``/``sampleBy`` draw from a generator seeded per partition, so
the rows chosen change with the partition layout.  We instead derive a 32-bit
number from the row key, a purpose tag and a seed:

    h = first 8 hex digits of md5("<key>:<purpose>:<seed>") as an integer

It is a pure function of the row, so it is the same on any cluster layout, it
survives executor loss and recomputation, it stays a plain filter (no shuffle,
parquet pushdown of the other predicates unaffected), and an SQL engine with
``md5`` computes the same value.  Different purposes give independent draws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 4294967296  # 2**32, h is in [0, HASH_RANGE)


def _key_string(key) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(c.cast("string"), F.lit(""))


def uniform_hash(key, purpose: str, seed: int = 42, *extra) -> Column:
    """bigint in [0, 2**32) from key, purpose tag and seed (extra parts appended)."""
    parts = [_key_string(key)]
    for e in extra:
        parts += [F.lit(":"), _key_string(e)]
    parts.append(F.lit(f":{purpose}:{seed}"))
    digest = F.md5(F.concat(*parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def unit_hash(key, purpose: str, seed: int = 42, *extra) -> Column:
    """double in [0, 1): uniform_hash / 2**32."""
    return uniform_hash(key, purpose, seed, *extra) / F.lit(float(HASH_RANGE))


def row_hash(columns, purpose: str, seed: int = 42) -> Column:
    """Hash of all given columns, for frames without a key (duplicates share a fate)."""
    packed = F.to_json(F.struct(*[F.col(c) for c in columns]))
    return uniform_hash(packed, purpose, seed)


def sql_uniform_hash(key_sql: str, purpose: str, seed: int = 42) -> str:
    """The same number as SQL text (used by the oracle)."""
    return (
        "cast(concat('0x', substr(md5(concat(coalesce(cast("
        f"{key_sql} as varchar), ''), ':{purpose}:{seed}')), 1, 8)) as bigint)"
    )
