"""Limits and samples that come out alike under any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.functions.text import rank_key


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample(df: DataFrame, key: list[str], n: int, seed: int) -> DataFrame:
    """n rows without replacement, by the hash of their key; n = 0 takes all."""
    if n == 0:
        return df
    return df.orderBy(rank_key(seed, *(F.col(c) for c in key)), *key).limit(n)
