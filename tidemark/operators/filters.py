"""Relative time ranges and retention."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import moment, span


@dataclass(frozen=True)
class Clock:
    """What "now" means for a query: a fixed moment, or the latest time stored in a table.

    The stored variant is a scalar subquery. The interval is subtracted *inside* it, so that the finished
    value is one literal at run time and still reaches the Parquet reader as a pushed filter.
    """

    fixed: Column | None = None
    table: DataFrame | None = None
    ts: str | None = None

    @staticmethod
    def at(value) -> "Clock":
        return Clock(fixed=moment(value))

    @staticmethod
    def latest(table: DataFrame, ts: str, date_col: str | None = None) -> "Clock":
        """The latest ``ts``; with the day column of a dated table only the last day is read."""
        if date_col:
            table = table.where(F.col(date_col) == table.agg(F.max(date_col).alias("day")).scalar())
        return Clock(table=table.select(ts), ts=ts)

    def value(self, shape=lambda now: now) -> Column:
        if self.table is None:
            return shape(self.fixed)
        return self.table.agg(shape(F.max(self.ts)).alias("moment")).scalar()

    def minus(self, interval: str) -> Column:
        return self.value(lambda now: now - span(interval))

    def date_minus(self, interval: str) -> Column:
        return self.value(lambda now: F.to_date(now - span(interval)))


def since(df: DataFrame, ts: str, interval: str, clock: Clock, date_col: str | None = None) -> DataFrame:
    """Rows with ``ts >= now - interval``.

    Zone-free timestamps are not compared with Parquet statistics by Spark; dates are. Name the day column
    of a dated table as ``date_col`` and whole folders and row groups are skipped.
    """
    kept = df.where(F.col(ts) >= clock.minus(interval))
    if date_col:
        kept = kept.where(F.col(date_col) >= clock.date_minus(interval))
    return kept


def retain(df: DataFrame, ts: str, days: int, clock: Clock, date_col: str | None = None) -> DataFrame:
    """Rows whose day is at most ``days`` before the current day."""
    day = F.col(date_col) if date_col else F.to_date(ts)
    return df.where(day >= clock.value(lambda now: F.date_sub(F.to_date(now), days)))


def apply_filters(df: DataFrame, selected: dict[str, list]) -> DataFrame:
    """Dashboard filters: each applies when the dataset has the column, and is skipped otherwise."""
    for column, values in selected.items():
        if column in df.columns:
            df = df.where(F.col(column).isin(list(values)))
    return df
