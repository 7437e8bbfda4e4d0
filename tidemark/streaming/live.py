"""Results kept up to date while events arrive."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import HOUR_PATTERN
from ..sources.writers import materialize
from .sync import _trigger

REFRESH_EVERY = "5 seconds"

HOURLY_DELTAS = "hour string, user_id bigint, session_id string, n bigint"


def refresh_queries(
    arrivals: DataFrame,
    store: Callable[[DataFrame, int], None],
    results: Callable[[SparkSession], Mapping[str, DataFrame]],
    out: str,
    checkpoint: str,
    every: str | None = REFRESH_EVERY,
) -> StreamingQuery:
    """Per trigger: store the new rows, then write every named result as a new version.

    What ``results`` reads is its own affair: from partial states (:mod:`.states`) a trigger costs what it brought.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        materialize(results(batch.sparkSession), out, batch_id)

    writer = arrivals.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


class HourCounts:
    """Event counts per hour, user and session, kept as the increments of each batch; reading sums them.

    A batch costs what it holds. Writing a batch again replaces its folder, so a replayed batch changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append_batch(self, events: DataFrame, batch_id: int) -> None:
        hour = F.date_format(F.date_trunc("hour", F.col("event_time")), HOUR_PATTERN)
        counted = events.groupBy(hour.alias("hour"), "user_id", "session_id").agg(F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")

    def current(self) -> DataFrame:
        deltas = self.spark.read.schema(HOURLY_DELTAS).parquet(self.root)
        return deltas.groupBy("hour", "user_id", "session_id").agg(F.sum("n").alias("n"))


def track_hours(events: DataFrame, counts: HourCounts, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Count the events of each batch into :class:`HourCounts`.

    Nothing is kept in state, so an event counts however late it comes. The keys are spread by user and session, so a
    busy hour is not one group.
    """
    writer = events.writeStream.foreachBatch(counts.append_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def hourly_activity(counts: HourCounts) -> DataFrame:
    """Exact events, users and sessions per hour from the tracked counts."""
    return (
        counts.current()
        .groupBy("hour")
        .agg(
            F.sum("n").alias("events"),
            F.count_distinct("user_id").alias("users"),
            F.count_distinct("session_id").alias("sessions"),
        )
        .orderBy("hour")
    )
