"""Reproducible splits and samples driven by a keyed hash."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.hashing import bucket, shuffle_order

TRAIN_VAL_TEST = {"train": 60, "val": 20, "test": 20}


def split_marker(keys: Sequence[str], shares: Mapping[str, int], salt: str = "") -> Column:
    """SP3: the name of the part a key belongs to; shares are percentages that sum to 100."""
    if sum(shares.values()) != 100:
        raise ValueError("shares must sum to 100")
    position = bucket(*keys, salt=salt)
    upper = 0
    marker: Column | None = None
    names = list(shares)
    for name in names[:-1]:
        upper += shares[name]
        inside = position < F.lit(upper)
        marker = F.when(inside, F.lit(name)) if marker is None else marker.when(inside, F.lit(name))
    return F.lit(names[-1]) if marker is None else marker.otherwise(F.lit(names[-1]))


def with_split(
    df: DataFrame, keys: Sequence[str], shares: Mapping[str, int] = TRAIN_VAL_TEST,
    column: str = "split", salt: str = "",
) -> DataFrame:
    return df.withColumn(column, split_marker(keys, shares, salt))


def parts(df: DataFrame, names: Sequence[str], column: str = "split") -> tuple[DataFrame, ...]:
    """One frame per part, marker dropped."""
    return tuple(df.filter(F.col(column) == name).drop(column) for name in names)


def split(df: DataFrame, keys: Sequence[str], first: int, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """SP1, SP2: two parts, the first with about ``first`` percent of the keys."""
    marked = with_split(df, keys, {"a": first, "b": 100 - first}, "_part", salt)
    left, right = parts(marked, ["a", "b"], "_part")
    return left, right


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int | str) -> DataFrame:
    """SP4, X18: a seeded sample of at most ``n`` rows (top-k of a hash, no full sort)."""
    return df.orderBy(shuffle_order(*keys, seed=seed), *keys).limit(n)
