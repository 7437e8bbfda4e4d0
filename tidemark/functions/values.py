"""Money and JSON access."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(10,2)"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rounded_sum(amount, digits: int) -> Column:
    """Sum of decimals, rounded half up as a decimal, handed out as double."""
    return F.round(F.sum(amount), digits).cast("double")


def json_field(document, path: str, kind: str = "string") -> Column:
    """One field of a JSON text column; a single field is cheaper to cut out than to parse whole."""
    return F.get_json_object(_col(document), path).cast(kind)


def variant_field(document, path: str, kind: str = "string") -> Column:
    """One field of a JSON text read as VARIANT; malformed text gives null."""
    return F.try_variant_get(F.try_parse_json(_col(document)), path, kind)
