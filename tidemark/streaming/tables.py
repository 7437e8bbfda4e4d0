"""A unique-key table fed by a stream of change batches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.changes import fold_changes

SNAPSHOT = -1  # base version of an initial snapshot
NOTHING = -2  # no base yet
COMPACT_EVERY = 50  # batches, after which a stream folds its log


class ChangeTable:
    """A compacted base plus a log of later change batches, all plain Parquet below one folder.

    A batch costs what it holds, not what the table holds: it is written to the folder named after its batch id,
    and keys are resolved when the table is read. Writing a batch again replaces the same folder, so a replayed
    batch changes nothing. ``compact`` folds the log into a new base; the base counts once its version is
    listed in ``commits``, which is the last step. The base keeps the ``seq`` of every row and the deletes as well, so
    that a change which arrives after its successor was folded in stays without effect. One stream writes to a table.
    """

    def __init__(self, spark: SparkSession, root: str, row_schema: str, keys: list[str], compact_every: int = COMPACT_EVERY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.row_schema = row_schema
        self.rows = T.StructType.fromDDL(row_schema)
        self.keys = keys
        self.compact_every = compact_every
        self.changes = T.StructType.fromDDL("op string, seq bigint")
        for field in self.rows.fields:
            self.changes.add(field)

    def append_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Store one batch of ``op, seq, <row columns>``, and fold the log every ``compact_every`` batches."""
        path = f"{self.root}/log/batch={batch_id}"
        changes.select(*self.changes.fieldNames()).write.mode("overwrite").parquet(path)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.compact()

    def load_snapshot(self, rows: DataFrame) -> None:
        """Store the initial rows as the base; the stream's batches, numbered from 0, follow it."""
        self._commit_base(rows.withColumns({"op": F.lit("r"), "seq": F.lit(0).cast("bigint")}), SNAPSHOT)

    def version(self) -> int:
        """Highest batch folded into the base."""
        commits = self._read(f"{self.root}/commits", T.StructType.fromDDL("version bigint"))
        return commits.agg(F.coalesce(F.max("version"), F.lit(NOTHING))).first()[0]

    def pending(self, version: int | None = None) -> DataFrame:
        """Change rows that are not in the base yet."""
        version = self.version() if version is None else version
        schema = T.StructType(list(self.changes.fields)).add("batch", T.LongType())
        return self._read(f"{self.root}/log", schema).where(F.col("batch") > version).drop("batch")

    def current(self) -> DataFrame:
        """The table as of the last stored batch."""
        return self._folded(self.version()).where(F.col("op") != "d").select(*self.rows.fieldNames())

    def _folded(self, version: int) -> DataFrame:
        base = self._read(f"{self.root}/base/version={version}", self.changes)
        return fold_changes(base, self.pending(version), self.keys)

    def compact(self) -> int:
        """Fold all stored batches into a new base and return its version."""
        version = self.version()
        log = self._read(f"{self.root}/log", T.StructType.fromDDL("batch bigint"))
        newest = log.agg(F.coalesce(F.max("batch"), F.lit(NOTHING))).first()[0]
        if newest > version:
            self._commit_base(self._folded(version), newest)
        return max(newest, version)

    def _commit_base(self, rows: DataFrame, version: int) -> None:
        rows.select(*self.changes.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/base/version={version}")
        done = self.spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
        done.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
