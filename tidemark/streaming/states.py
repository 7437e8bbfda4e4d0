"""Activity kept as partial states: what each batch adds, merged when read, rolled up now and then."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import hour_label, span
from ..operators.bitmaps import distinct_counts, marked, merged
from ..operators.filters import Clock
from ..operators.ids import assign_ids
from .sync import _trigger

NOTHING = -1
ROLL_EVERY = 50  # batches, after which a stream rolls its states up

SUMS = "hour string, event_type string, n bigint"
BITS = "hour string, kind string, bucket bigint, bits binary"
SESSIONS = "session_id string, number bigint"
TABLES = {"sums": SUMS, "bits": BITS, "sessions": SESSIONS}


class ActivityStates:
    """Events by hour and type as sums, users and sessions by hour as bitmaps, all plain Parquet below one folder.

    A batch writes what it adds to folders named by its id; writing it again replaces them, so a replay changes nothing, and
    an event counts in its hour however late it comes. Sessions get dense numbers in the order in which batches bring them,
    from a table that is part of the state; users are numbered already. ``roll`` merges the batches so far into a new base,
    which counts once its version is in ``commits``; a read opens one base and at most ``roll_every`` batches.
    """

    def __init__(self, spark: SparkSession, root: str, roll_every: int = ROLL_EVERY):
        self.spark, self.root, self.roll_every = spark, root.rstrip("/"), roll_every

    # -- writing ------------------------------------------------------------------------------------------

    def append_batch(self, events: DataFrame, batch_id: int) -> None:
        """Add ``user_id, session_id, event_type, event_time`` rows; a null user or session is none."""
        known = self._table("sessions", before=batch_id)
        fresh = events.select("session_id").where("session_id IS NOT NULL").distinct().join(known, "session_id", "left_anti")
        top = known.agg(F.coalesce(F.max("number"), F.lit(-1)).alias("top")).first()["top"]
        self._write(assign_ids(fresh, top, ["session_id"], "number"), "sessions", batch_id)
        sums, bits = self._states(events, self._table("sessions", before=batch_id + 1))
        self._write(sums, "sums", batch_id)
        self._write(bits, "bits", batch_id)
        if self.roll_every and (batch_id + 1) % self.roll_every == 0:
            self.roll()

    @staticmethod
    def _states(events: DataFrame, sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
        timed = events.select(hour_label("event_time").alias("hour"), "event_type", "user_id", "session_id")
        sums = timed.groupBy("hour", "event_type").agg(F.count(F.lit(1)).alias("n"))
        return sums, marked(timed.join(sessions, "session_id", "left"), ["hour"], user="user_id", session="number")

    def roll(self) -> int:
        """Merge all stored batches into a new base and return its version. Nothing is closed by it: later batches add to any hour."""
        version, newest = self.version(), self._newest()
        if newest > version:
            sums = self._table("sums").groupBy("hour", "event_type").agg(F.sum("n").alias("n"))
            for name, rows in (("sums", sums), ("bits", merged(self._table("bits"), ["hour"])), ("sessions", self._table("sessions"))):
                # Sorted, so that a window leaves the row groups of earlier hours unread.
                rows.sortWithinPartitions(rows.columns[0]).write.mode("overwrite").parquet(f"{self.root}/base/{name}/version={newest}")
            self.spark.range(1).select(F.lit(newest).cast("bigint").alias("version")).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return max(version, newest)

    def _write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch_id}")

    # -- reading ------------------------------------------------------------------------------------------

    def version(self) -> int:
        """Highest batch that is part of the base."""
        return self._read(f"{self.root}/commits", "version bigint").agg(F.coalesce(F.max("version"), F.lit(NOTHING))).first()[0]

    def _newest(self) -> int:
        # The last table that a batch writes: a batch that was stopped before is not complete, and comes again.
        return self._read(f"{self.root}/bits", "batch bigint").agg(F.coalesce(F.max("batch"), F.lit(NOTHING))).first()[0]

    def _table(self, name: str, before: int | None = None) -> DataFrame:
        """Base and later batches of one table; with ``before``, batches below it only."""
        version = self.version()
        schema = T.StructType.fromDDL(TABLES[name])
        base = self._read(f"{self.root}/base/{name}/version={version}", schema)
        later = self._read(f"{self.root}/{name}", T.StructType(list(schema.fields)).add("batch", T.LongType())).where(F.col("batch") > version)
        return base.unionByName((later if before is None else later.where(F.col("batch") < before)).drop("batch"))

    def _read(self, path: str, schema) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def window(self, facts: DataFrame | None = None, interval: str | None = None, clock: Clock | None = None) -> tuple[DataFrame, DataFrame]:
        """Sums and bitmaps of the events since ``now - interval``; of all without one.

        Whole hours come from the states; only the hour that the window begins in is read from ``facts``.
        """
        sums, bits = self._table("sums"), self._table("bits")
        if interval is None:
            return sums, bits
        hour = clock.value(lambda now: hour_label(now - span(interval)))
        edge = facts.where((F.col("event_time") >= clock.minus(interval)) & (hour_label("event_time") == hour))
        edge_sums, edge_bits = self._states(edge, self._table("sessions"))
        return sums.where(F.col("hour") > hour).unionByName(edge_sums), bits.where(F.col("hour") > hour).unionByName(edge_bits)

    @staticmethod
    def counts(states: tuple[DataFrame, DataFrame], level: Column | None = None, name: str = "hour") -> DataFrame:
        """``events, users, sessions``, by ``level`` (an expression over the hour) or in all; an hour without events has no row."""
        sums, bits = states
        keys = [] if level is None else [name]
        if level is not None:
            sums, bits = sums.withColumn(name, level), bits.withColumn(name, level)
        events = sums.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("events"))
        seen = distinct_counts(bits, keys, users="user", sessions="session")
        if not keys:
            return events.withColumn("x", seen.select(F.struct("*").alias("x")).scalar()).select("events", F.coalesce("x.users", F.lit(0)).alias("users"), F.coalesce("x.sessions", F.lit(0)).alias("sessions"))
        # Rows without any user or session number have no bitmap.
        joined = events.withColumnRenamed(name, "_key").join(seen, F.col("_key").eqNullSafe(F.col(name)), "left")
        return joined.select(F.col("_key").alias(name), "events", F.coalesce("users", F.lit(0)).alias("users"), F.coalesce("sessions", F.lit(0)).alias("sessions"))

    def by_type(self) -> DataFrame:
        return self._table("sums").groupBy("event_type").agg(F.sum("n").alias("count"))


def track_activity(events: DataFrame, states: ActivityStates, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Add the events of each batch to the states."""
    writer = events.writeStream.foreachBatch(states.append_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()
