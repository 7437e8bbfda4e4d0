"""Counts and distinct counts over facts joined to dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def tally(facts: DataFrame, keys: list[str | Column], **sums: str) -> DataFrame:
    """Facts collapsed to one row per key combination, with the row count ``n`` and optional sums.

    Done before a dimension join: a dimension too large to broadcast then meets one row per combination,
    not one per fact, and a key that owns a third of the facts shrinks inside each task first.
    """
    return facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(column).alias(name) for name, column in sums.items()]
    )


def count_by(df: DataFrame, keys: list[str | Column], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def high_water_mark(df: DataFrame, key: str) -> Column:
    """Largest key so far, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("top")).scalar()
