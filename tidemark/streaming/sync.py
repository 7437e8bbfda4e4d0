"""Streams into tables: keyed sync, append sinks and bounded batches."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import decode_changes
from .dated import DatedTable
from .tables import ChangeTable

# Fixed values of the ingestion jobs: checkpoint interval, record, time and byte limits of a flush.
CHECKPOINT_EVERY = "10 seconds"
FLUSH_RECORDS = 1000
FLUSH_EVERY = "10 seconds"
FLUSH_BYTES = 1_000_000
TELEMETRY_BATCH_RECORDS = 10_000
TELEMETRY_BATCH_EVERY = "10 seconds"

# What a query shuffled is removed when it ends, instead of when the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _trigger(writer, every: str | None):
    """``every`` keeps the stream running; without it all present input is processed, then the query ends."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


@dataclass(frozen=True)
class TableSync:
    """One table to keep in sync: a stream of ``op, seq, <row columns>`` and where it goes."""

    name: str
    changes: DataFrame
    table: ChangeTable


def sync_table(spec: TableSync, checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = (
        spec.changes.writeStream.queryName(f"sync_{spec.name}")
        .foreachBatch(spec.table.append_batch)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def sync_tables(specs: list[TableSync], checkpoint_root: str, every: str | None = None) -> dict[str, StreamingQuery]:
    """One query per table, each with a checkpoint of its own, so a table can fail and resume alone."""
    return {s.name: sync_table(s, f"{checkpoint_root}/{s.name}", every) for s in specs}


def chosen(names, tables: list[str] | str) -> list[str]:
    """The names that a list of tables or a name pattern covers; a listed table that is not there is an error."""
    if isinstance(tables, str):
        return sorted(n for n in names if re.fullmatch(tables, n))
    missing = sorted(set(tables) - set(names))
    if missing:
        raise ValueError(f"no target table for {missing}")
    return sorted(tables)


def fan_out(
    source: DataFrame,
    targets: dict[str, ChangeTable],
    checkpoint: str,
    tables: list[str] | str = ".*",
    every: str | None = None,
) -> StreamingQuery:
    """One stream of ``table, value`` change envelopes into the tables that a list or a name pattern covers.

    A batch is read once and stored in each table under the same id. After a stop between two tables the batch comes
    again from the checkpoint, and tables that had it replace it by the same rows. An envelope of a table that the pattern
    covers, but that has no target, stops the job; tables outside the list or pattern are passed over.
    """
    names = chosen(targets, tables)
    covered = F.col("table").rlike(f"^(?:{tables})$") if isinstance(tables, str) else F.col("table").isin(tables)

    def store(batch: DataFrame, batch_id: int) -> None:
        held = batch.where(covered).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stray = held.where(~F.col("table").isin(names)).select("table").first()
            if stray:
                raise ValueError(f"no target table for {stray['table']!r}")
            for name in names:
                target = targets[name]
                changes = decode_changes(held.where(F.col("table") == name), "value", target.row_schema, target.keys)
                target.append_batch(changes, batch_id)
        finally:
            held.unpersist()

    return _trigger(source.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), every).start()


def append_stream(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, records_per_file: int | None = None
) -> StreamingQuery:
    """Append rows to Parquet files exactly once; the sink's own log drops a repeated batch.

    ``records_per_file`` bounds each output file, the source's per-trigger options bound each batch.
    """
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    return _trigger(writer, every).start()


def dated_stream(df: DataFrame, table: DatedTable, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append rows to a table by day; a repeated batch replaces itself, and the rows it shuffled go when it is written."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set(DROP_SHUFFLES, "true")  # the session is the stream's own
        table.append_batch(batch, batch_id)

    return _trigger(df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), every).start()


def wait(queries) -> None:
    """Wait for bounded queries to end; an error of any is raised."""
    for q in queries.values() if isinstance(queries, dict) else queries:
        q.awaitTermination()
