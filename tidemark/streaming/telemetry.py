"""Telemetry documents from files into three tables by day."""

from __future__ import annotations

from functools import cache

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.telemetry import FLATTEN, OTLP, run_pipeline
from .dated import DatedTable
from .sync import dated_stream


@cache
def _shape(signal: str) -> StructType:
    """Columns of a signal's records; filters do not change them."""
    spark = SparkSession.active()
    return FLATTEN[signal](spark.createDataFrame([], OTLP[signal])).schema


def signal_tables(spark: SparkSession, out: str) -> dict[str, DatedTable]:
    """The tables ``otel_logs``, ``otel_traces``, ``otel_metrics`` below ``out``."""
    return {signal: DatedTable(spark, f"{out}/otel_{signal}", _shape(signal)) for signal in OTLP}


def ingest_signals(
    spark: SparkSession,
    inputs: dict[str, str],
    out: str,
    checkpoint_root: str,
    every: str | None = None,
    pipelines=None,
    bytes_per_trigger: int | None = None,
) -> dict[str, StreamingQuery]:
    """One stream per signal into its table; ``bytes_per_trigger`` bounds a batch by the size of its files, ``every`` by time."""
    tables, queries = signal_tables(spark, out), {}
    for signal, path in inputs.items():
        reader = spark.readStream.schema(OTLP[signal])
        if bytes_per_trigger:
            reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
        records = run_pipeline(reader.json(path), signal, pipelines)
        queries[signal] = dated_stream(records, tables[signal], f"{checkpoint_root}/{signal}", every)
    return queries
