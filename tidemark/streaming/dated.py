"""An append table by day, fed by a stream, whose days are packed and expire."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.folders import data_files, partition_values, remove_folder

DAY, BATCH = "event_date", "batch"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # folder of the rows without a time
PACKED_BYTES = 128 * 1024 * 1024
PACK_AT_ONCE = 8


class DatedTable:
    """Rows in ``rows/event_date=D/batch=N``; small files of a day move to ``packed/event_date=D/pack=N``.

    A batch replaces only its own folders, one for each day it holds rows of, so a replayed batch changes nothing and a
    late record goes to its day. A pack takes in a day's batches up to ``N`` and counts once it is listed in ``packs``,
    which is the last step; until then the batches count. The newest batch, which may be delivered again, is never packed.

    ``expire`` lists the first day to keep in ``floors`` before it removes older ones: from then on they are neither read
    nor written, so that a replay does not bring them back. Rows without a time have a folder of their own and stay.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, ts: str = "timestamp"):
        self.spark, self.root, self.schema, self.ts = spark, root.rstrip("/"), schema, ts

    def append_batch(self, rows: DataFrame, batch_id: int) -> None:
        placed = rows.select(*self.schema.fieldNames()).withColumns({DAY: F.to_date(self.ts), BATCH: F.lit(batch_id).cast("bigint")})
        # Rows meet by day, so that a batch of many days writes few files; adaptive execution splits a day that is large.
        writer = self._kept(placed).hint("rebalance", F.col(DAY)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY, BATCH).parquet(f"{self.root}/rows")

    def current(self) -> DataFrame:
        """All rows of the days kept, with their day; filters on the day reach whole folders."""
        packs = self._packs()
        newest = {}
        for day, pack in packs:
            newest[day] = max(pack, newest.get(day, -1))
        fresh = self._read("rows", BATCH)
        if newest:
            # The lists hold one line per day or pack; both conditions are on folder names, so files are left out unopened.
            upto = F.create_map(*[F.lit(x) for pair in newest.items() for x in pair])
            fresh = fresh.where(F.col(BATCH) > F.coalesce(upto[_name()], F.lit(-1)))
        rows = self._kept(fresh).drop(BATCH)
        if not packs:
            return rows
        listed = F.concat_ws("/", _name(), F.col("pack")).isin([f"{day}/{pack}" for day, pack in packs])
        return rows.unionByName(self._kept(self._read("packed", "pack").where(listed)).drop("pack"))

    def pack(self, target: int = PACKED_BYTES) -> list[str]:
        """Pack each day that holds two batches or more besides the newest one; returns those days.

        The scan itself puts small files together up to ``target`` bytes a task, and each task writes one file: rows are
        not shuffled. ``PACK_AT_ONCE`` days are packed side by side.
        """
        days = {d: [int(b) for b in partition_values(self.spark, f"{self.root}/rows/{DAY}={d}", BATCH)] for d in self._days("rows")}
        last = max((b for batches in days.values() for b in batches), default=-1)
        packs, todo = self._packs(), {}
        for day, batches in days.items():
            before = max((pack for d, pack in packs if d == day), default=-1)
            folded = sorted(b for b in batches if before < b < last)
            if len(folded) > 1:
                todo[day] = folded
        scan = self.spark.newSession()
        scan.conf.set("spark.sql.files.maxPartitionBytes", str(target))
        scan.conf.set("spark.sql.files.openCostInBytes", "0")
        scan.conf.set("spark.sql.files.minPartitionNum", "1")

        def fold(day: str) -> None:
            folders = [f"{self.root}/rows/{DAY}={day}/{BATCH}={b}" for b in todo[day]]
            rows = scan.read.schema(self.schema).parquet(*folders)
            rows.write.mode("overwrite").parquet(f"{self.root}/packed/{DAY}={day}/pack={todo[day][-1]}")

        with ThreadPoolExecutor(PACK_AT_ONCE) as pool:
            list(pool.map(fold, todo))
        if todo:
            self._note("packs", "day string, pack bigint", [(day, folded[-1]) for day, folded in todo.items()])
        return sorted(todo)

    def clean(self) -> int:
        """Remove batches that a listed pack holds, and packs that were never listed; call it when no reader is older."""
        packs, removed = set(self._packs()), 0
        for day in self._days("rows"):
            newest = max((pack for d, pack in packs if d == day), default=-1)
            for batch in partition_values(self.spark, f"{self.root}/rows/{DAY}={day}", BATCH):
                if int(batch) <= newest:
                    removed += remove_folder(self.spark, f"{self.root}/rows/{DAY}={day}/{BATCH}={batch}")
        for day in self._days("packed"):
            for pack in partition_values(self.spark, f"{self.root}/packed/{DAY}={day}", "pack"):
                if (day, int(pack)) not in packs:
                    removed += remove_folder(self.spark, f"{self.root}/packed/{DAY}={day}/pack={pack}")
        return removed

    def expire(self, days: int, today: dt.date) -> list[str]:
        """Drop the days before ``today - days`` and return those that were stored."""
        floor = max(filter(None, [self.floor(), (today - dt.timedelta(days=days)).isoformat()]))
        if floor != self.floor():
            self._note("floors", "day string", [(floor,)])
        expired = {d for kind in ("rows", "packed") for d in self._days(kind) if d != NO_DAY and d < floor}
        for day in sorted(expired):
            for kind in ("rows", "packed"):
                remove_folder(self.spark, f"{self.root}/{kind}/{DAY}={day}")
        return sorted(expired)

    def floor(self) -> str | None:
        """The first day kept, None when nothing has expired so far."""
        return self._noted("floors", "day string").agg(F.max("day")).first()[0]

    def files(self) -> DataFrame:
        """``path``, ``length`` of all data files, those left over from packing included."""
        return data_files(self.spark, *[f"{self.root}/{kind}" for kind in ("rows", "packed") if self._days(kind)])

    def _days(self, kind: str) -> list[str]:
        return partition_values(self.spark, f"{self.root}/{kind}", DAY)

    def _kept(self, rows: DataFrame) -> DataFrame:
        floor = self.floor()
        return rows if floor is None else rows.where(F.col(DAY).isNull() | (F.col(DAY) >= F.lit(floor).cast("date")))

    def _packs(self) -> list[tuple[str, int]]:
        return [(r["day"], r["pack"]) for r in self._noted("packs", "day string, pack bigint").collect()]

    def _note(self, what: str, schema: str, lines: list[tuple]) -> None:
        self.spark.createDataFrame(lines, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{what}")

    def _noted(self, what: str, schema: str) -> DataFrame:
        return self._opened(what, T.StructType.fromDDL(schema))

    def _read(self, kind: str, number: str) -> DataFrame:
        return self._opened(kind, T.StructType(list(self.schema.fields)).add(DAY, T.DateType()).add(number, T.LongType()))

    def _opened(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{path}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def _name() -> Column:
    """The day as its folder is named."""
    return F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY))
