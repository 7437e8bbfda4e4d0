"""Top-k, ranks over a bounded head, and the latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows; every task keeps ``k`` and only those travel."""
    return df.orderBy(*order).limit(k)


def ranked_head(df: DataFrame, k: int, order: list[Column], name: str) -> DataFrame:
    """The first ``k`` rows numbered from 1; the unpartitioned window sees those ``k`` rows only."""
    return top_k(df, k, *order).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def head_per_group(df: DataFrame, keys: list[str], k: int, order: list[Column], name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group, numbered.

    The rank filter is also applied before the shuffle, so a group that holds much of the table sends
    ``k`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def latest_per_key(df: DataFrame, keys: list[str], *newest_first: Column) -> DataFrame:
    """One row per key: the first in the given order."""
    return head_per_group(df, keys, 1, list(newest_first), "_rank").drop("_rank")
