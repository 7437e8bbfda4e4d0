"""Dense surrogate keys without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed


def assign_ids(df: DataFrame, top: Column | int, order: list[str | Column], name: str) -> DataFrame:
    """Number the rows ``top + 1, top + 2, ...`` in the given order of columns or sort expressions.

    The rows are range-partitioned on the whole order (end it with a unique column, then no value can fill a
    partition), and kept by a checkpoint, because the partition sizes and the numbers must come from one and the
    same layout even when executors are lost. Only one row per partition goes through the offset window.
    """
    spark = df.sparkSession
    laid_out = (
        df.repartitionByRange(*[F.col(c) if isinstance(c, str) else c for c in order])
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()})
    )
    kept = checkpointed(spark, laid_out)
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    start = top if isinstance(top, Column) else F.lit(top)
    # One row per partition, so its size is bound by the layout and not by the data.
    numbered = kept.join(F.broadcast(offsets), "_part").withColumn(
        name, (start + F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("bigint")
    )
    return numbered.drop("_part", "_pos", "_first", "_offset")
