"""Deterministic hashes used for splitting, sampling and digests.

All are md5 based so that a SQL engine other than Spark can reproduce them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_md5(key: str | Column, seed: int | str) -> Column:
    """Hex md5 of ``'<seed>:<key>'``."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hashed_key60(key: str | Column, seed: int | str) -> Column:
    """First 15 hex digits of the seeded md5 as a non-negative long (60 bits).

    Ordering by this value equals ordering by the hex text, up to prefix ties.
    """
    return F.conv(F.substring(seeded_md5(key, seed), 1, 15), 16, 10).cast("long")


def hash_fraction(key: str | Column, seed: int | str) -> Column:
    """First 8 hex digits of the seeded md5 as an integer in [0, 2^32)."""
    return F.conv(F.substring(seeded_md5(key, seed), 1, 8), 16, 10).cast("long")


def row_digest60(cols: list[Column]) -> Column:
    """60-bit md5 prefix of a row's canonical text, as a long (for order-free digests)."""
    text = F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
