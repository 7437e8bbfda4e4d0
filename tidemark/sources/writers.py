"""Append sinks, dated fact tables, seeding and materialised query results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def append(df: DataFrame, path: str, records_per_file: int | None = None) -> None:
    """Append rows as they are; repeats are kept."""
    writer = df.write.mode("append")
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.parquet(path)


def write_dated(df: DataFrame, path: str, ts: str, date_col: str = "event_date", mode: str = "append") -> None:
    """A fact table partitioned by day, which range filters and retention prune by folder.

    Rows are rebalanced by day: AQE splits a day that is too large for one task and joins small ones.
    """
    dated = df.withColumn(date_col, F.to_date(ts)).hint("rebalance", date_col)
    dated.write.mode(mode).partitionBy(date_col).parquet(path)


def save_dated(df: DataFrame, table: str, ts: str, date_col: str = "event_date") -> None:
    """The same as a catalog table, whose days :func:`expire_days` can drop."""
    dated = df.withColumn(date_col, F.to_date(ts)).hint("rebalance", date_col)
    dated.write.mode("append").format("parquet").partitionBy(date_col).saveAsTable(table)


def expire_days(
    spark: SparkSession, table: str, days: int, today: dt.date, date_col: str = "event_date"
) -> list[str]:
    """Drop the day partitions before ``today - days`` and return them; no row is read or rewritten.

    The partition list holds one line per stored day.
    """
    first_kept = (today - dt.timedelta(days=days)).isoformat()
    stored = [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    expired = sorted(day for day in stored if day < first_kept)
    for day in expired:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({date_col} = DATE'{day}')")
    return expired


def ensure_table(spark: SparkSession, name: str, schema, path: str | None = None) -> bool:
    """Create a table when it is missing; True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    writer = spark.createDataFrame([], schema).write.format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return True


def seed_if_empty(spark: SparkSession, name: str, seed: DataFrame) -> bool:
    """Insert the seed rows when the table holds none; True when they were inserted."""
    if not spark.table(name).isEmpty():
        return False
    seed.select(*spark.table(name).columns).write.insertInto(name)
    return True


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Stop a fact load whose dimension is still empty."""
    if df.isEmpty():
        raise ValueError(f"{name} holds no rows; load the dimensions before the facts")
    return df


def materialize(results: Mapping[str, DataFrame], root: str, version: int | None = None) -> dict[str, str]:
    """Write each named result as a dataset of its own, all in a new version folder, and return the paths.

    The version counts once it is named in ``versions``, which is the last step: a reader sees the results of one version
    whole, also while the next is written. A version that is written again, after a stop, replaces what was left of it.
    """
    spark = next(iter(results.values())).sparkSession
    if version is None:
        version = latest_version(spark, root) + 1
    paths = {name: f"{root}/version={version}/{name}" for name in results}
    for name, df in results.items():
        df.write.mode("overwrite").parquet(paths[name])
    row = spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return paths


def latest_version(spark: SparkSession, root: str) -> int:
    """The newest complete version of materialised results, -1 for none."""
    try:
        versions = spark.read.schema("version bigint").parquet(f"{root}/versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    return versions.agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]


def materialized(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One result of the newest complete version."""
    return spark.read.parquet(f"{root}/version={latest_version(spark, root)}/{name}")
