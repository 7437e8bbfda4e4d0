"""Registered queries and the SQL each must equal."""

from .base import ORACLES, QUERIES
from . import analytics, charts, expressions, ingestion, retrieval, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
