"""Row counts, reconciliation, freshness and declared constraints."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .filters import Clock


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``tbl``, ``cnt``."""
    return stacked(
        [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt") for name, df in tables.items()]
    ).orderBy("tbl")


def _row_hash(columns: list[str]) -> Column:
    # xxhash64 skips nulls, so flags are added to tell (null, x) from (x, null).
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns]) if columns else F.lit(0).cast("bigint")


def reconcile(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: is it missing in the target, extra there, different, or the same?

    Both sides are stacked and grouped once. Repeats of a key collapse inside each task and are compared as a
    multiset, where a full outer join would pair every copy with every other.
    """
    if set(source.columns) != set(target.columns):
        raise ValueError(f"columns differ: {sorted(set(source.columns) ^ set(target.columns))}")
    # A value of another type may be the same value: both sides are compared in the type that holds either.
    common = source.limit(0).unionByName(target.limit(0)).schema
    source, target = (side.select(*[F.col(f.name).cast(f.dataType) for f in common.fields]) for side in (source, target))
    columns = sorted(set(source.columns) - set(keys))
    digest = _row_hash(columns).cast("decimal(20,0)").alias("digest")
    sides = source.select(*keys, digest, F.lit(True).alias("in_source")).unionByName(
        target.select(*keys, digest, F.lit(False).alias("in_source"))
    )
    there = F.col("in_source")
    grouped = sides.groupBy(*keys).agg(
        F.count_if(there).alias("source_rows"),
        F.count_if(~there).alias("target_rows"),
        F.sum(F.when(there, F.col("digest"))).alias("source_digest"),
        F.sum(F.when(~there, F.col("digest"))).alias("target_digest"),
    )
    status = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "extra")
        .when(
            (F.col("source_rows") == F.col("target_rows")) & (F.col("source_digest") == F.col("target_digest")), "same"
        )
        .otherwise("different")
    )
    return grouped.select(*keys, "source_rows", "target_rows", status.alias("status"))


def reconcile_summary(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and rows per status."""
    return (
        reconcile(source, target, keys)
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("keys"),
            F.sum("source_rows").alias("source_rows"),
            F.sum("target_rows").alias("target_rows"),
        )
    )


def freshness(df: DataFrame, ts: str, clock: Clock) -> DataFrame:
    """Latest time and its lag behind now in whole seconds."""
    latest = df.agg(F.max(ts).alias("latest"))
    now = clock.value()
    lag = F.timestamp_diff("SECOND", F.col("latest"), now)
    return latest.select("latest", lag.alias("lag_seconds"))


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class MaxLength:
    column: str
    limit: int


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class References:
    column: str
    parent: DataFrame
    parent_key: str


def constraint_report(df: DataFrame, rules: list) -> DataFrame:
    """``rule``, ``violations``: rows for row rules and references, repeated values for uniqueness.

    All row rules share one scan. References are checked once per distinct value.
    """
    frames, row_rules = [], {}
    for rule in rules:
        match rule:
            case NotNull(column):
                row_rules[f"not_null:{column}"] = F.col(column).isNull()
            case MaxLength(column, limit):
                row_rules[f"max_length:{column}"] = F.length(column) > limit
            case Unique(columns):
                repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                frames.append(_violations(f"unique:{','.join(columns)}", repeated, F.count(F.lit(1))))
            case References(column, parent, parent_key):
                used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
                orphans = used.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")
                frames.append(_violations(f"references:{column}", orphans, F.coalesce(F.sum("n"), F.lit(0))))
            case _:
                raise TypeError(f"unknown rule {rule!r}")
    if row_rules:
        names = list(row_rules)
        counts = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, broken in enumerate(row_rules.values())])
        pairs = F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").alias("violations"))
                for i, name in enumerate(names)
            ]
        )
        frames.append(counts.select(F.inline(pairs)))
    return stacked(frames).orderBy("rule")


def _violations(rule: str, broken: DataFrame, measure: Column) -> DataFrame:
    return broken.agg(measure.cast("bigint").alias("violations")).select(F.lit(rule).alias("rule"), "violations")
