"""Streams over several batches, restarts, late rows and refreshes."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as ch
from tidemark.sources.readers import read_json_stream, read_table_stream
from tidemark.sources.writers import latest_version, materialize, materialized
from tidemark.streaming import live, sync
from tidemark.streaming.tables import ChangeTable

ROW = "id bigint, v string"


def drop_file(folder, number, lines):
    """One input file; the modification time fixes the order in which the stream takes it."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{number:03}.json"
    with open(path, "w") as f:
        f.writelines(json.dumps(line) + "\n" for line in lines)
    stamp = time.time() - 1000 + number
    os.utime(path, (stamp, stamp))


def change(op, seq, key, value):
    row = {"id": key, "v": value}
    return {"op": op, "seq": seq, "before": row if op == "d" else None, "after": None if op == "d" else row}


def test_keyed_sync_over_batches_and_restarts(spark, work):
    source = f"{work}/in"
    drop_file(source, 1, [change("c", 1, 1, "a"), change("c", 2, 2, "b")])
    drop_file(source, 2, [change("d", 4, 1, "a"), change("u", 3, 1, "x")])  # out of order
    table = ChangeTable(spark, f"{work}/t", ROW, ["id"])

    def run():
        stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(source)
        sync.wait(sync.sync_tables([sync.TableSync("t", ch.decode_changes(stream, "value", ROW, ["id"]), table)], f"{work}/c"))
        return {r["id"]: r["v"] for r in table.current().collect()}

    assert run() == {2: "b"}
    assert run() == {2: "b"}
    table.compact()
    drop_file(source, 3, [change("c", 5, 1, "back"), change("u", 6, 2, "B")])
    assert run() == {1: "back", 2: "B"}


def test_one_source_for_several_tables_goes_on_after_a_stop(spark, work):
    """The first run stops between two tables; the batch comes again, and no table has it twice or not at all."""
    message = lambda table, *a: {"table": table, "value": json.dumps(change(*a))}
    drop_file(f"{work}/in", 1, [message("dim_a", "c", 1, 1, "a"), message("dim_b", "c", 1, 7, "b"), message("fact_c", "c", 1, 9, "c"), message("other", "c", 1, 1, "x")])
    drop_file(f"{work}/in", 2, [message("dim_a", "u", 2, 1, "A"), message("dim_b", "d", 2, 7, "b"), message("fact_c", "c", 2, 10, "d")])
    tables = {n: ChangeTable(spark, f"{work}/{n}", ROW, ["id"]) for n in ("dim_a", "dim_b", "fact_c")}

    def run(targets=tables, pattern="(dim|fact)_.*"):
        lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{work}/in")
        source = lines.select(F.from_json("value", "table string, value string").alias("m")).select("m.*")
        sync.wait([sync.fan_out(source, targets, f"{work}/c", pattern)])

    class Stopping(ChangeTable):
        def append_batch(self, changes, batch_id):
            if batch_id == 1:
                raise RuntimeError("stopped here")
            super().append_batch(changes, batch_id)

    stopping = {**tables, "dim_b": Stopping(spark, f"{work}/dim_b", ROW, ["id"])}
    with pytest.raises(Exception, match="stopped here"):
        run(stopping)
    assert tables["dim_a"].pending().count() == 2 and tables["fact_c"].pending().count() == 1
    run()
    found = {n: {r["id"]: r["v"] for r in t.current().collect()} for n, t in tables.items()}
    assert found == {"dim_a": {1: "A"}, "dim_b": {}, "fact_c": {9: "c", 10: "d"}}
    assert [t.pending().count() for t in tables.values()] == [2, 2, 2]


def test_tables_by_list_and_by_pattern(spark, work):
    assert sync.chosen(["a1", "a2", "b"], "a.") == ["a1", "a2"] and sync.chosen(["a1", "b"], ["b"]) == ["b"]
    with pytest.raises(ValueError, match="no target table"):
        sync.chosen(["a1"], ["zz"])
    drop_file(f"{work}/in", 1, [{"table": "dim_z", "value": "{}"}])
    source = spark.readStream.format("text").load(f"{work}/in").select(F.from_json("value", "table string, value string").alias("m")).select("m.*")
    with pytest.raises(Exception, match="no target table"):
        sync.wait([sync.fan_out(source, {"dim_a": ChangeTable(spark, f"{work}/a", ROW, ["id"])}, f"{work}/c", "dim_.*")])


def test_sync_fails_alone(spark, work):
    drop_file(f"{work}/a", 1, [change("c", 1, 1, "a")])
    drop_file(f"{work}/b", 1, [{"topic": "unknown"}])
    good = ChangeTable(spark, f"{work}/good", ROW, ["id"])
    bad = ChangeTable(spark, f"{work}/bad", "topic string", ["topic"])
    lines = spark.readStream.format("text").load(f"{work}/b").select(F.from_json("value", "topic string").alias("r")).select("r.*")
    failing = ch.routed(lines, "topic", {}).select(F.lit("u").alias("op"), F.lit(1).cast("bigint").alias("seq"), F.col("target_table").alias("topic"))
    stream = ch.decode_changes(spark.readStream.format("text").load(f"{work}/a"), "value", ROW, ["id"])
    queries = sync.sync_tables([sync.TableSync("good", stream, good), sync.TableSync("bad", failing, bad)], f"{work}/c")
    queries["good"].awaitTermination()
    with pytest.raises(Exception, match="no target table"):
        queries["bad"].awaitTermination()
    assert good.current().count() == 1


def test_append_is_exactly_once(spark, work):
    for number in range(3):
        drop_file(f"{work}/in", number, [{"id": number, "v": "x"}] * 2)
    for _ in range(2):
        stream = read_json_stream(spark, f"{work}/in", ROW, (), 1)
        sync.wait([sync.append_stream(stream, f"{work}/out", f"{work}/c", records_per_file=1)])
    found = spark.read.parquet(f"{work}/out")
    assert found.count() == 6
    assert found.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] == 1


def event(i, user, session, at):
    return {"event_id": i, "user_id": user, "session_id": session, "event_time": at}


EVENT = "event_id bigint, user_id bigint, session_id string, event_time string"


def test_hours_match_the_batch_answer_and_count_late_rows(spark, work):
    drop_file(f"{work}/in", 1, [event(1, 1, "a", "2024-01-01 10:00:00"), event(2, 2, "b", "2024-01-01 10:30:00.5")])
    drop_file(f"{work}/in", 2, [event(3, 1, "a", "2024-01-01 10:59:59"), event(4, 1, "c", "2024-01-01 11:10:00")])
    drop_file(f"{work}/in", 3, [event(5, 3, "d", "2024-01-01 10:01:00"), event(6, 3, "d", "2024-01-01 20:00:00")])
    drop_file(f"{work}/in", 4, [event(7, 4, "e", "2024-01-01 20:05:00")])
    drop_file(f"{work}/in", 5, [event(8, 4, "e", "2024-01-01 10:02:00")])  # ten hours after later ones
    table = live.HourCounts(spark, f"{work}/t")
    for _ in range(2):
        stream = read_json_stream(spark, f"{work}/in", EVENT, ["event_time"], 1)
        sync.wait([live.track_hours(stream, table, f"{work}/c")])
    assert [tuple(r) for r in live.hourly_activity(table).collect()] == [
        ("2024-01-01 10:00:00", 5, 4, 4),
        ("2024-01-01 11:00:00", 1, 1, 1),
        ("2024-01-01 20:00:00", 2, 2, 2),
    ]


def test_refresh_rewrites_results_per_trigger(spark, work):
    for number in range(2):
        drop_file(f"{work}/in", number, [{"id": number, "v": "x"}])
    seen = []

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{work}/rows/batch={batch_id}")

    def results(session):
        counted = session.read.parquet(f"{work}/rows").groupBy("v").count()
        seen.append(counted.first()["count"])
        return {"by_value": counted}

    arrivals = read_json_stream(spark, f"{work}/in", ROW, (), 1)
    sync.wait([live.refresh_queries(arrivals, store, results, f"{work}/out", f"{work}/c", every=None)])
    assert seen == [1, 2]
    assert materialized(spark, f"{work}/out", "by_value").first()["count"] == 2
    assert spark.read.parquet(f"{work}/out/version=0/by_value").first()["count"] == 1  # for readers that opened it


def test_a_version_counts_when_it_is_whole(spark, work):
    one, two = spark.range(1), spark.range(2)
    assert latest_version(spark, f"{work}/m") == -1
    materialize({"a": one, "b": one}, f"{work}/m")
    broken = two.select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        materialize({"a": two, "b": broken}, f"{work}/m")
    assert latest_version(spark, f"{work}/m") == 0 and materialized(spark, f"{work}/m", "a").count() == 1
    materialize({"a": two, "b": two}, f"{work}/m")
    assert latest_version(spark, f"{work}/m") == 1 and materialized(spark, f"{work}/m", "a").count() == 2


def test_table_stream_takes_a_file_or_a_folder(spark, work):
    spark.range(5).coalesce(1).write.parquet(f"{work}/t.parquet")
    schema = spark.read.parquet(f"{work}/t.parquet").schema
    stream = read_table_stream(spark, f"{work}/t.parquet*", schema, 1)
    sync.wait([sync.append_stream(stream, f"{work}/o", f"{work}/c")])
    assert spark.read.parquet(f"{work}/o").count() == 5


def test_a_late_change_after_compaction_changes_nothing(spark, work):
    table = ChangeTable(spark, f"{work}/t", "id bigint, v string", ["id"], compact_every=0)
    log = "op string, seq bigint, id bigint, v string"
    table.append_batch(spark.createDataFrame([("u", 10, 1, "new"), ("d", 11, 2, "gone")], log), 0)
    assert table.compact() == 0
    table.append_batch(spark.createDataFrame([("u", 5, 1, "old"), ("u", 6, 2, "old")], log), 1)
    assert [tuple(r) for r in table.current().collect()] == [(1, "new")]
    assert table.compact() == 1 and [tuple(r) for r in table.current().collect()] == [(1, "new")]


def test_a_stream_folds_its_log(spark, work):
    table = ChangeTable(spark, f"{work}/t", "id bigint, v string", ["id"], compact_every=2)
    for batch in range(5):
        table.append_batch(spark.createDataFrame([("u", batch, 1, str(batch))], "op string, seq bigint, id bigint, v string"), batch)
    assert table.version() == 3 and [tuple(r) for r in table.current().collect()] == [(1, "4")]
