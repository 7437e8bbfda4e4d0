"""Vector expressions over ``array<float>`` columns; sums run in double."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def vector_literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def parse_vector(text) -> Column:
    """``'[0.1,0.2]'`` to ``array<float>``."""
    return F.from_json(_col(text), "array<float>")


def cosine_similarity(a, b) -> Column:
    """Null for null, zero-length or differently sized vectors."""
    a, b = _col(a), _col(b)
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(F.size(a) == F.size(b), _dot(a, b) / F.nullif(norms, F.lit(0.0)))


def cosine_distance(a, b) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)
