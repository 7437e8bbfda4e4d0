"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import broadcast_if_small, checkpointed, work_path

#: Bits of a row's number that tell its place in a file.
PLACE_BITS = 36

__all__ = ["checkpointed", "columns_of", "crc_mod", "handed", "numbered", "rejected", "slices", "stored", "table", "text_blob", "tidy", "work_path"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def columns_of(df: DataFrame, **wanted: str) -> DataFrame:
    """The wanted columns under this library's names; whatever else ``df`` has, clashing names included, is left behind."""
    return df.select(*[F.col(f"`{column}`").alias(name) for name, column in wanted.items()])


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the fold of a row. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n, F.lit(0))


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` into the shared folder and read it back: later steps neither repeat nor lose the work."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, key: str, label: str, compression: str = "snappy") -> DataFrame:
    """``stored``, with equal keys in files of one bucket: a join on the key reads them where they lie and shuffles the other side.

    There are as many buckets as a shuffle has partitions, so that side needs one shuffle. The table's entry in the catalog is
    of no use afterwards and names the folder only.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    name = f"{label}_{path[-32:]}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(parts, key).option("path", path).option("compression", compression).saveAsTable(name, format="parquet")
    return spark.table(name)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for every row, and the name of that column.

    Stages that keep some rows decide by it: ids may repeat or be null, and a row read twice is two rows. Rows of a table of
    files are numbered by file and place, which any later read finds again; rows of any other plan are stored first.
    """
    row = "_row"
    while row in docs.columns:
        row = f"_{row}"
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(f"{row}_file"), F.col("_metadata.row_index").alias(f"{row}_place"))
        files = sorted(r[0] for r in placed.select(f"{row}_file").distinct().collect())
    except AnalysisException:
        return stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row
    # One row per file, so its size is that of the layout.
    numbers = docs.sparkSession.createDataFrame(list(zip(files, range(len(files)))), f"{row}_file string, {row} bigint")
    met = placed.join(broadcast_if_small(numbers, len(files)), f"{row}_file")
    whole = F.shiftleft(row, PLACE_BITS).bitwiseOR(F.col(f"{row}_place"))
    return met.select(*[F.col(f"`{c}`") for c in docs.columns], whole.alias(row)), row


def rejected(rows: DataFrame, row: str, text: str, judge: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The numbers (column ``row``) of the rows whose text a judge does not accept; each task makes a judge of its own.

    Only number and text go to the tasks and only numbers come back, so whole rows never pass through Python.
    """

    def reject(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = judge()
        for batch in slices(batches, "text", 2 << 20):
            bad = pa.array([not g for g in good(batch.column("text").to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(bad)], ["row"])

    found = columns_of(rows, row=row, text=text).mapInArrow(tidy(reject), "row bigint")
    return stored(found.select(F.col("row").alias(row)), "rejected")


@contextlib.contextmanager
def handed(spark: SparkSession, size: int) -> Iterator[None]:
    """Batches of about ``size`` bytes between Spark and Python for what is written meanwhile, instead of so many rows of any length.

    A smaller size that the session has set stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    if before is None or not before.isdigit() or int(before) > size:
        spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The task, which gives the memory it has freed back to the system when it ends: workers live on, for tasks of any kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call, nothing is lost
                ctypes.CDLL(None).malloc_trim(0)

    return run


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of ``column`` in each take about ``size`` bytes; a longer text comes alone."""
    for batch in batches:
        ends = np.cumsum(text_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_lengths(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text; a null has none."""
    if not len(texts):
        return np.zeros(0, np.int64)
    wide = 8 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else 4
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide == 8 else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    lengths = np.diff(offsets).astype(np.int64)
    if texts.null_count:
        lengths[~np.asarray(texts.is_valid())] = 0
    return lengths


def text_blob(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts as one string of bytes, each followed by a line feed, and where each begins. Nulls are empty."""
    blob = b"".join([t + b"\n" for t in (x or b"" for x in texts.fill_null("").cast(pa.large_binary()).to_pylist())])
    return blob, np.concatenate([[0], np.cumsum(text_lengths(texts) + 1)[:-1]]) if len(texts) else np.zeros(0, np.int64)
