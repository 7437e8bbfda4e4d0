"""Relational snapshots, JSON messages and topics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.times import parse_wall_clock


def snapshot_options(url: str, table: str, key: str, bounds: tuple[int, int], partitions: int) -> dict[str, str]:
    """JDBC options of a snapshot read split into key ranges, so no task reads the whole table."""
    low, high = bounds
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int = 64,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Snapshot of a relational table; the driver class must be on the class path."""
    options = snapshot_options(url, table, key, bounds, partitions) | (properties or {})
    return spark.read.format("jdbc").options(**options).load()


def read_snapshot(spark: SparkSession, path: str, columns: dict[str, str | Column], kind: str = "parquet") -> DataFrame:
    """Snapshot kept as files: pick, rename and widen columns in the scan's own projection."""
    df = spark.read.format(kind).load(path)
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )


def spread(df: DataFrame) -> DataFrame:
    """Share a small input's rows among all cores before costly per-row work.

    One small file is one task, however much work its rows cause. An input that is split at least as often as there
    are cores, as every large one is, stays as it is and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Column of a message's text when it cannot be parsed.
BROKEN = "_broken"


def parse_messages(df: DataFrame, value: str, schema: str, times: Iterable[str] = ()) -> DataFrame:
    """JSON text values to columns; the listed text columns become zone-free timestamps.

    A message that is null or no JSON object stops the job, before it becomes a row of nulls with a null key; set such
    messages aside with :func:`rejected_messages`.
    """
    told = F.concat(F.lit("unreadable message: "), F.coalesce(F.substring(F.col(value).cast("string"), 1, 200), F.lit("null")))
    parsed = _messages(df, value, schema)
    names = T.StructType.fromDDL(schema).fieldNames()
    first = F.when(F.col("m").isNull() | F.col(f"m.{BROKEN}").isNotNull(), F.raise_error(told)).otherwise(F.col("m"))
    rows = parsed.select(first.alias("m")).select(*[F.col(f"m.{name}") for name in names])
    return rows.withColumns({name: parse_wall_clock(name) for name in times})


def _messages(df: DataFrame, value: str, schema: str) -> DataFrame:
    told = T.StructType.fromDDL(schema).add(BROKEN, T.StringType())
    return df.withColumn("m", F.from_json(F.col(value).cast("string"), told, {"columnNameOfCorruptRecord": BROKEN}))


def rejected_messages(df: DataFrame, value: str, schema: str) -> DataFrame:
    """The rows whose message :func:`parse_messages` cannot read, as they came."""
    return _messages(df, value, schema).where(F.col("m").isNull() | F.col(f"m.{BROKEN}").isNotNull()).drop("m")


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    times: Iterable[str] = (),
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Message files of one JSON object per line, as a stream; a batch is bounded by files or by their bytes, not both."""
    reader = spark.readStream.format("text").schema(T.StructType.fromDDL("value string"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return parse_messages(reader.load(path), "value", schema, times)


def read_topic_stream(
    spark: SparkSession,
    servers: str,
    topics: str,
    schema: str,
    times: Iterable[str] = (),
    offsets_per_trigger: int = 1_000_000,
) -> DataFrame:
    """The same messages from Kafka; needs the connector package on the class path."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", offsets_per_trigger)
        .load()
    )
    return parse_messages(stream, "value", schema, times)


def read_table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of one table as a stream; ``path`` may be a file, a folder or a glob."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
