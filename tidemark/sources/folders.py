"""Folders of a stored table: what lies in them, and their removal. Any file system that Spark can open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _opened(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the ``column=value`` folders directly below ``path``, sorted; empty where there is no such folder."""
    files, folder = _opened(spark, path)
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder) if entry.isDirectory()]
    return sorted(name.split("=", 1)[1] for name in names if name.startswith(f"{column}="))


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all it holds; False when it was not there."""
    files, folder = _opened(spark, path)
    return files.delete(folder, True)


def data_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path``, ``length`` of all Parquet files below the paths; file contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(list(paths)).select("path", "length")
