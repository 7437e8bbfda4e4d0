"""Tables by day: late records, replays, packing, expiry."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.sources.folders import partition_values
from tidemark.streaming import sync
from tidemark.streaming.dated import NO_DAY, DatedTable

ROW = T.StructType().add("id", T.LongType()).add("timestamp", T.TimestampNTZType())


def rows(spark, *pairs):
    return spark.createDataFrame([(i, d) for i, d in pairs], "id bigint, d string").select("id", F.col("d").cast("timestamp_ntz").alias("timestamp"))


def ids(table):
    return sorted(r["id"] for r in table.current().collect())


@pytest.fixture
def table(spark, work):
    table = DatedTable(spark, f"{work}/t", ROW)
    table.append_batch(rows(spark, (1, "2024-05-01 10:00:00"), (2, "2024-05-02 10:00:00"), (3, None)), 0)
    table.append_batch(rows(spark, (4, "2024-05-02 11:00:00"), (5, "2024-05-03 10:00:00")), 1)
    table.append_batch(rows(spark, (6, "2024-05-02 09:00:00")), 2)
    return table


def test_nothing_yet(spark, work):
    table = DatedTable(spark, f"{work}/none", ROW)
    assert table.current().columns == ["id", "timestamp", "event_date"] and ids(table) == []
    assert table.pack() == [] and table.clean() == 0 and table.floor() is None


def test_a_replay_replaces_its_own_folders_only(spark, table):
    table.append_batch(rows(spark, (4, "2024-05-02 11:00:00"), (5, "2024-05-03 10:00:00")), 1)
    assert ids(table) == [1, 2, 3, 4, 5, 6]


def test_packing_keeps_the_rows_and_leaves_the_newest_batch(spark, table):
    assert table.pack() == ["2024-05-02"]
    assert ids(table) == [1, 2, 3, 4, 5, 6]  # the packed batches lie there still, and are passed over
    assert table.clean() == 2 and ids(table) == [1, 2, 3, 4, 5, 6]
    assert partition_values(spark, f"{table.root}/rows/event_date=2024-05-02", "batch") == ["2"]
    table.append_batch(rows(spark, (6, "2024-05-02 09:00:00")), 2)  # the newest batch again
    table.append_batch(rows(spark, (7, "2024-05-02 12:00:00")), 3)
    table.append_batch(rows(spark, (8, "2024-05-04 12:00:00")), 4)
    assert table.pack() == ["2024-05-02"] and ids(table) == [1, 2, 3, 4, 5, 6, 7, 8]
    table.clean()
    assert partition_values(spark, f"{table.root}/packed/event_date=2024-05-02", "pack") == ["1", "3"]
    assert ids(table) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_a_pack_that_was_never_listed_does_not_count(spark, table):
    rows(spark, (2, "2024-05-02 10:00:00")).write.parquet(f"{table.root}/packed/event_date=2024-05-02/pack=0")
    assert ids(table) == [1, 2, 3, 4, 5, 6]
    assert table.clean() == 1 and ids(table) == [1, 2, 3, 4, 5, 6]


def test_expired_days_do_not_come_back(spark, table):
    table.pack()
    assert table.expire(1, dt.date(2024, 5, 3)) == ["2024-05-01"]
    assert table.expire(0, dt.date(2024, 5, 3)) == ["2024-05-02"]
    assert ids(table) == [3, 5]
    table.append_batch(rows(spark, (1, "2024-05-01 10:00:00"), (2, "2024-05-02 10:00:00"), (3, None)), 0)
    assert ids(table) == [3, 5]
    assert partition_values(spark, f"{table.root}/rows", "event_date") == ["2024-05-03", NO_DAY]
    assert table.expire(9, dt.date(2024, 5, 3)) == [] and table.floor() == "2024-05-03"  # a floor never sinks


def test_a_day_is_pruned_by_folder(spark, table):
    table.pack()
    plan = table.current().where("event_date = DATE'2024-05-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_batches_are_admitted_by_bytes_and_packed_by_size(spark, work):
    for n in range(6):
        rows(spark, *[(n * 1000 + i, "2024-05-01 10:00:00") for i in range(1000)]).coalesce(1).write.parquet(f"{work}/in/{n}")
    size = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{work}/in/*").agg(F.max("length")).first()[0]
    stream = spark.readStream.schema(ROW).option("maxBytesPerTrigger", size + 1).parquet(f"{work}/in/*")
    table = DatedTable(spark, f"{work}/out", ROW)
    sync.wait([sync.dated_stream(stream, table, f"{work}/checkpoint")])
    folder = f"{table.root}/rows/event_date=2024-05-01"
    assert len(partition_values(spark, folder, "batch")) >= 3
    assert table.pack() == ["2024-05-01"] and table.clean() >= 2
    assert table.files().count() == 2  # one packed, one of the newest batch
    assert ids(table) == list(range(6000))


def test_a_running_stream_keeps_to_its_time(spark, work):
    rows(spark, (1, "2024-05-01 10:00:00")).write.parquet(f"{work}/in")
    table = DatedTable(spark, f"{work}/out", ROW)
    query = sync.dated_stream(spark.readStream.schema(ROW).parquet(f"{work}/in"), table, f"{work}/checkpoint", sync.CHECKPOINT_EVERY)
    try:
        query.processAllAvailable()
        assert ids(table) == [1] and query.isActive
    finally:
        query.stop()


def test_shuffled_rows_go_with_their_batch(spark, work):
    """They would add up to all that a stream has read, until the driver happens to collect its garbage."""

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "/shuffle_" in f}

    def left():  # looking the floor up leaves some bytes a task, the 3,000 texts some hundred thousand
        return sum(Path(f).stat().st_size for f in shuffled() - before if Path(f).exists())

    digest = "sha2(CAST(id AS STRING), 512)"
    day = "timestamp_ntz'2024-05-01 10:00:00' + make_dt_interval(CAST(id % 9 AS INT)) AS timestamp"
    spark.range(3000, numPartitions=12).selectExpr("id", day, f"{digest} || reverse({digest}) AS text").write.parquet(f"{work}/in")
    before, wide = shuffled(), T.StructType([*ROW.fields]).add("text", T.StringType())
    stream = spark.readStream.schema(wide).option("maxFilesPerTrigger", 4).parquet(f"{work}/in")
    table = DatedTable(spark, f"{work}/out", wide)
    sync.wait([sync.dated_stream(stream, table, f"{work}/checkpoint")])
    until = time.time() + 20  # the files are removed beside what follows
    while left() > 50_000 and time.time() < until:
        time.sleep(0.2)
    assert left() <= 50_000
    assert ids(table) == list(range(3000)) and len(partition_values(spark, f"{table.root}/rows/event_date=2024-05-01", "batch")) > 1
    assert spark.conf.get(sync.DROP_SHUFFLES, "false") == "false"  # other queries of the session keep theirs
