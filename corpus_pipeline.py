"""The corpus pipeline: five stages over documents, each written as Parquet and read back by the next.

The first four stages return the documents they keep, with all columns; the last returns the packed pieces of what is left.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, exact_dedup, jaccard, langid, packing
from tidemark.llm.common import handed, stored, table

#: Bytes of rows that pass between Spark and Python at once; both sides of a worker hold them while other stages' caches live on.
HANDED_BYTES = 4 << 20


def _bounded(stage: Callable) -> Callable:
    """The stage with small batches; its Python steps are all written before it returns."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with handed(spark, HANDED_BYTES):
            return stage(spark, docs, sf_dir)

    return run_stage


@_bounded
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts that are null or without letters, and unsure ones, go."""
    return langid.accepted(docs)


@_bounded
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest document, then the smallest id, of those that are equal but for white space."""
    return exact_dedup.keep_first(docs)


@_bounded
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that links of 0.8 and more join."""
    return jaccard.keep_one(docs)


@_bounded
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@_bounded
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents, each with its sequence and place there."""
    return packing.pack(docs, lean=True)


STAGES = [
    ("language identification", language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", packed),
]

#: Language identification is a trained model, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
