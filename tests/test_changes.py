"""Change application, routing, ids, defaults, sinks and data quality."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import changes as ch, quality as q
from tidemark.operators.filters import Clock, retain
from tidemark.operators.ids import assign_ids
from tidemark.sources import readers, writers as w
from tidemark.sources.schemas import EVENT_MESSAGE
from tidemark.streaming.tables import ChangeTable

ROW = "id bigint, v string"


def log(spark, *changes):
    return spark.createDataFrame(list(changes), "op string, seq bigint, id bigint, v string")


def table(df):
    return {r["id"]: r["v"] for r in df.collect()}


def base(spark):
    return spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], ROW)


def test_order_comes_from_seq_not_arrival(spark):
    changes = log(spark, ("c", 40, 7, "again"), ("u", 20, 7, "b"), ("d", 30, 7, "b"), ("c", 10, 7, "a"))
    assert table(ch.apply_upserts(base(spark), changes, ["id"])) == {1: "one", 2: "two", 3: "three", 7: "again"}


def test_delete_update_insert(spark):
    changes = log(spark, ("d", 1, 1, "one"), ("u", 2, 2, "TWO"), ("c", 3, 4, "four"))
    assert table(ch.apply_upserts(base(spark), changes, ["id"])) == {2: "TWO", 3: "three", 4: "four"}


def test_decode_takes_deletes_from_the_before_image(spark):
    sent = [
        {"op": "c", "seq": 1, "before": None, "after": {"id": 1, "v": "a"}},
        {"op": "d", "seq": 2, "before": {"id": 1, "v": "a"}, "after": None},
    ]
    df = spark.createDataFrame([(json.dumps(s),) for s in sent], "value string")
    found = ch.decode_changes(df, "value", ROW, ["id"]).orderBy("seq").collect()
    assert [(r["op"], r["id"], r["v"]) for r in found] == [("c", 1, "a"), ("d", 1, "a")]
    with pytest.raises(ValueError, match="nope"):
        ch.decode_changes(df, "value", ROW, ["nope"])


def test_unreadable_changes_stop_the_job_or_are_set_aside(spark):
    good = json.dumps({"op": "c", "seq": 1, "before": None, "after": {"id": 1, "v": "a"}})
    bad = [
        json.dumps({"op": "x", "seq": 3, "before": None, "after": {"id": 1, "v": "a"}}),
        json.dumps({"op": "u", "seq": 4, "before": None, "after": {"v": "a"}}),
        json.dumps({"op": "u", "seq": 5}),
        "{broken",
        None,
    ]
    df = spark.createDataFrame([(v,) for v in [good, *bad]], "value string")
    with pytest.raises(Exception, match="unreadable change"):
        ch.decode_changes(df, "value", ROW, ["id"]).collect()
    assert ch.decode_changes(df, "value", ROW, ["id"], skip_rejected=True).count() == 1
    rejected = ch.rejected_changes(df, "value", ROW, ["id"])
    assert rejected.columns == ["value"] and sorted(r.value or "" for r in rejected.collect()) == sorted(b or "" for b in bad)


def test_fold_keeps_deletes_and_sequence(spark):
    log = "op string, seq bigint, id bigint, v string"
    base = spark.createDataFrame([("u", 10, 1, "new"), ("d", 11, 2, "gone"), ("r", 0, 3, "still")], log)
    late = spark.createDataFrame([("u", 5, 1, "old"), ("u", 6, 2, "old"), ("u", 7, 3, "next"), ("u", 8, 4, "fresh")], log)
    found = {r.id: (r.op, r.seq, r.v) for r in ch.fold_changes(base, late, ["id"]).collect()}
    assert found == {1: ("u", 10, "new"), 2: ("d", 11, "gone"), 3: ("u", 7, "next"), 4: ("u", 8, "fresh")}


def test_reconcile_compares_values_whatever_their_types(spark):
    narrow = spark.sql("SELECT 1 AS id, CAST(5 AS INT) AS n, CAST(1.5 AS FLOAT) AS x")
    wide = spark.sql("SELECT CAST(1 AS BIGINT) AS id, CAST(5 AS BIGINT) AS n, CAST(1.5 AS DOUBLE) AS x")
    assert [r.status for r in q.reconcile(narrow, wide, ["id"]).collect()] == ["same"]
    with pytest.raises(ValueError, match="columns differ"):
        q.reconcile(narrow, wide.drop("x"), ["id"])


def test_snapshot_comes_first(spark):
    found = ch.snapshot_then_changes(base(spark), log(spark, ("d", 1, 1, "one")))
    assert table(ch.apply_upserts(base(spark).limit(0), found, ["id"])) == {2: "two", 3: "three"}


def test_small_batch_leaves_the_base_in_place(spark, work):
    base(spark).write.parquet(work + "/base")
    log(spark, ("u", 1, 1, "x")).write.parquet(work + "/log")
    merged = ch.apply_upserts(spark.read.parquet(work + "/base"), spark.read.parquet(work + "/log"), ["id"])
    assert "BroadcastHashJoin" in merged._jdf.queryExecution().executedPlan().toString()


def test_routing(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "topic string, n int")
    found = ch.routed(df, "topic", {"a": "ta", "b": "tb"}).collect()
    assert [r["target_table"] for r in found] == ["ta", "tb"]
    with pytest.raises(PySparkException, match="no target table for topic b"):
        ch.routed(df, "topic", {"a": "ta"}).collect()


def test_insert_ignore(spark):
    new = spark.createDataFrame([(3, "other"), (4, "b"), (4, "a")], ROW)
    assert table(ch.insert_ignore(base(spark), new, ["id"], F.asc("v"))) == {1: "one", 2: "two", 3: "three", 4: "a"}


def test_default_only_when_absent(spark):
    df = spark.createDataFrame([('{"id":1}',), ('{"id":2,"v":null}',), ('{"id":3,"v":"x"}',)], "j string")
    assert table(ch.with_defaults(df, "j", ROW, {"v": "Free"})) == {1: "Free", 2: None, 3: "x"}


def test_ids_are_dense_and_ordered_with_a_hot_key(spark):
    df = spark.range(0, 3000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("u")
    )
    found = assign_ids(df, 100, ["k", "u"], "new").orderBy("new").collect()
    assert [r["new"] for r in found] == list(range(101, 3101))
    assert [(r["k"], r["u"]) for r in found] == sorted((r["k"], r["u"]) for r in found)


def test_ids_of_nothing(spark):
    assert assign_ids(spark.createDataFrame([], ROW), 0, ["id"], "new").count() == 0


def test_messages_with_and_without_fraction(spark):
    sent = [
        '{"event_id":1,"event_time":"2024-01-15 10:30:00","properties":"{\\"duration\\":120}"}',
        '{"event_id":2,"event_time":"2024-01-15 10:30:00.123456"}',
        '{"event_id":3,"event_time":"soon"}',
    ]
    df = spark.createDataFrame([(s,) for s in sent], "value string")
    found = readers.parse_messages(df, "value", EVENT_MESSAGE, ["event_time"]).orderBy("event_id").collect()
    assert [str(r["event_time"]) for r in found] == ["2024-01-15 10:30:00", "2024-01-15 10:30:00.123456", "None"]
    assert json.loads(found[0]["properties"]) == {"duration": 120}


def test_snapshot_read_is_split():
    options = readers.snapshot_options("jdbc:x", "t", "id", (1, 1000), 16)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "16"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1000")


def test_create_and_seed_once(spark, work):
    seed = base(spark)
    assert w.ensure_table(spark, "tidemark_seeded", seed.schema, work + "/t")
    assert not w.ensure_table(spark, "tidemark_seeded", seed.schema, work + "/t")
    assert w.seed_if_empty(spark, "tidemark_seeded", seed)
    assert not w.seed_if_empty(spark, "tidemark_seeded", seed)
    assert spark.table("tidemark_seeded").count() == 3
    spark.sql("DROP TABLE tidemark_seeded")


def test_empty_dimension_stops_the_load(spark):
    assert w.require_rows(base(spark), "users").count() == 3
    with pytest.raises(ValueError, match="users holds no rows"):
        w.require_rows(base(spark).limit(0), "users")


def test_dated_table_is_written_by_day(spark, work):
    df = spark.sql("SELECT id, timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS ts FROM range(72)")
    w.write_dated(df, work + "/d", "ts")
    found = spark.read.parquet(work + "/d")
    assert found.count() == 72 and found.select("event_date").distinct().count() == 3


def test_old_days_are_dropped(spark, work):
    spark.sql(f"CREATE DATABASE tidemark_days LOCATION '{work}/db'")
    try:
        df = spark.sql("SELECT id, timestamp_ntz'2024-01-01' + make_dt_interval(id) AS ts FROM range(10)")
        w.save_dated(df, "tidemark_days.t", "ts")
        kept = retain(df, "ts", 7, Clock.at("2024-01-10 05:00:00"))
        assert w.expire_days(spark, "tidemark_days.t", 7, dt.date(2024, 1, 10)) == ["2024-01-01", "2024-01-02"]
        assert spark.table("tidemark_days.t").count() == kept.count() == 8
        assert w.expire_days(spark, "tidemark_days.t", 7, dt.date(2024, 1, 10)) == []
    finally:
        spark.sql("DROP DATABASE tidemark_days CASCADE")


def test_reconcile(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (4, "d")], ROW)
    target = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (5, "e"), (3, None)], ROW)
    found = {r["id"]: r["status"] for r in q.reconcile(source, target, ["id"]).collect()}
    assert found == {1: "same", 2: "different", 3: "same", 4: "different", 5: "extra"}


def test_reconcile_sees_where_the_null_is(spark):
    schema = "id int, x int, y int"
    a, b = spark.createDataFrame([(1, None, 5)], schema), spark.createDataFrame([(1, 5, None)], schema)
    assert q.reconcile(a, b, ["id"]).first()["status"] == "different"


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (9, "long"), (None, None)], ROW)
    rules = [q.NotNull("v"), q.MaxLength("v", 3), q.Unique(("v",)), q.References("id", base(spark), "id")]
    found = {r["rule"]: r["violations"] for r in q.constraint_report(df, rules).collect()}
    assert found == {"not_null:v": 1, "max_length:v": 1, "unique:v": 1, "references:id": 1}


def test_freshness(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS ts")
    assert q.freshness(df, "ts", Clock.at("2024-01-01 00:01:30")).first()["lag_seconds"] == 90


def test_change_table_replay_and_compaction(spark, work):
    t = ChangeTable(spark, work + "/t", ROW, ["id"])
    assert t.current().count() == 0
    t.load_snapshot(base(spark))
    first, second = log(spark, ("u", 1, 1, "ONE")), log(spark, ("d", 2, 2, "two"))
    t.append_batch(first, 0)
    t.append_batch(first, 0)
    assert table(t.current()) == {1: "ONE", 2: "two", 3: "three"}
    assert t.compact() == 0
    t.append_batch(first, 0)  # replayed after it was folded in
    t.append_batch(second, 1)
    assert table(t.current()) == {1: "ONE", 3: "three"}
    assert t.compact() == 1 and t.compact() == 1
    assert t.pending().count() == 0 and table(t.current()) == {1: "ONE", 3: "three"}


def test_broken_messages_stop_the_job_or_are_set_aside(spark):
    df = spark.createDataFrame([('{"id": 1, "v": "a"}',), ("{broken",), (None,), ('{"v": "no id"}',)], "value string")
    with pytest.raises(Exception, match="unreadable message"):
        readers.parse_messages(df, "value", ROW).collect()
    assert {r.value for r in readers.rejected_messages(df, "value", ROW).collect()} == {"{broken", None}
    good = readers.parse_messages(df.where("value LIKE '{\"%'"), "value", ROW)
    assert sorted(map(str, good.collect())) == ["Row(id=1, v='a')", "Row(id=None, v='no id')"]
