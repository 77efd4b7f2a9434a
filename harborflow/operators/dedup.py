"""Row selection by key: deduplication, latest row, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], first_by: Sequence[str], *, last: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) by `first_by`, which must not tie.

    A partial aggregate reduces copies before the shuffle, so a key with very many copies costs
    one row per map task rather than one huge group.
    """
    best = F.max_by if last else F.min_by
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*others)
    picked = df.groupBy(*keys).agg(best(row, F.struct(*first_by)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def drop_redelivered(df: DataFrame, keys: Sequence[str] = ("mmsi", "event_time"), tie: str = "offset") -> DataFrame:
    """Keep one row per key, the one with the lowest tie value."""
    return pick_one(df, keys, [tie])


def top_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The `n` keys with most rows; equal counts are ordered by key."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), F.col(key)).limit(n)


def top_rows(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*by).limit(n)
