"""Keyed, partition-independent pseudo-randomness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 7  # 28 bits: far above any bucket count, and safe in a BIGINT


def _text(*keys: str | Column) -> Column:
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def bucket(*keys: str | Column, buckets: int = 100, salt: str = "") -> Column:
    """Stable bucket ``0..buckets-1`` of a key; the same row gets the same bucket on
    any cluster size, retry or engine that has MD5."""
    text = _text(*keys)
    if salt:
        text = F.concat(F.lit(salt), text)
    head = F.substring(F.md5(text), 1, HEX_DIGITS)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets).cast("bigint"))


def shuffle_order(*keys: str | Column, seed: int | str) -> Column:
    """A seeded pseudo-random sort key."""
    return F.md5(F.concat(F.lit(f"{seed}|"), _text(*keys)))
