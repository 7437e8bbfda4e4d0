"""Time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

HOUR_PATTERN = "yyyy-MM-dd HH:00:00"


def moment(value) -> Column:
    """A wall-clock literal as ``timestamp_ntz``; columns pass through."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def span(interval: str) -> Column:
    """``'30 DAYS'`` or ``'24 HOURS'`` as an interval column."""
    return F.expr(f"INTERVAL {interval}")


def parse_wall_clock(text) -> Column:
    """Timestamps written with or without a fraction; malformed text gives null."""
    return F.col(text).try_cast("timestamp_ntz") if isinstance(text, str) else text.try_cast("timestamp_ntz")


def hour_label(ts) -> Column:
    """Hour bucket as text, ``2024-01-01 13:00:00``."""
    return F.date_format(ts, HOUR_PATTERN)


def whole_seconds(ts) -> Column:
    """Drop the fraction of a second and keep the column's zone-free type."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("second", column).cast("timestamp_ntz")


def in_zone(ts, zone: str) -> Column:
    """Stored UTC wall clock shown as wall clock of ``zone``; the session zone plays no part."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), column)
