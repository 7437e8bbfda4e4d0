"""Exact distinct counts that can be merged: bitmaps over numbered keys, one per range of 32,768 numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def marked(rows: DataFrame, keys: list[str], **numbers: str | Column) -> DataFrame:
    """``keys, kind, bucket, bits``: which numbers of each kind occur for each combination of keys; nulls are none of them.

    A bitmap has 4 KB whatever it holds, so the numbers should be dense. Bitmaps are built in each task before the shuffle.
    """
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), (F.col(n) if isinstance(n, str) else n).cast("bigint").alias("number")) for kind, n in numbers.items()])
    each = rows.select(*keys, F.explode(kinds).alias("x")).select(*keys, "x.kind", "x.number").where("number IS NOT NULL")
    return each.groupBy(*keys, "kind", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def merged(bits: DataFrame, keys: list[str]) -> DataFrame:
    """The same at a coarser level of ``keys``."""
    return bits.groupBy(*keys, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bits: DataFrame, keys: list[str], **kinds: str) -> DataFrame:
    """``keys`` and one distinct count per named kind, 0 where it has no number: no key is expanded or counted by value."""
    sizes = merged(bits, keys).select(*keys, "kind", F.bitmap_count("bits").alias("size"))
    counts = [F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("size"))), F.lit(0)).alias(name) for name, kind in kinds.items()]
    return sizes.groupBy(*keys).agg(*counts)
