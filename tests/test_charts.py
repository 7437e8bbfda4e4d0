"""Chart rules."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import charts as c

ROWS = [
    ("2024-01-01 10:15:00", "Free", "a", 1),
    ("2024-01-01 10:45:00", "Pro", "a", 2),
    ("2024-01-01 11:00:00", "Pro", "b", 3),
    ("2024-01-02 09:00:00", None, "b", 4),
]


@pytest.fixture(scope="module")
def dataset(spark):
    df = spark.createDataFrame(ROWS, "t string, plan string, item string, n int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    return c.Dataset(df, c.Roles(times=("t",), not_groupable=("n",), not_filterable=("item",)))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_keys_are_checked(dataset):
    with pytest.raises(ValueError, match="unknown column nope"):
        c.chart_query(dataset, [c.ROW_COUNT], ["nope"])
    with pytest.raises(ValueError, match="cannot be grouped"):
        c.chart_query(dataset, [c.ROW_COUNT], ["n"])
    with pytest.raises(ValueError, match="cannot be filtered"):
        dataset.filtered({"item": ["a"]})
    with pytest.raises(ValueError, match="unknown aggregate"):
        c.Metric.of("n", "MEDIAN")
    with pytest.raises(ValueError, match="no time column"):
        c.trend(c.Dataset(dataset.df))


def test_grouping_order_and_limit(dataset):
    metrics = [c.Metric.of("n"), c.Metric.sql("COUNT(*)", "c")]
    assert rows(c.chart_query(dataset, metrics, ["plan"], limit=2)) == [("Pro", 5, 2), (None, 4, 1)]
    assert rows(c.chart_query(dataset, metrics, ["plan"], order_desc=False))[0] == ("Free", 1, 1)
    assert rows(c.big_number(dataset, c.Metric.of("plan", "COUNT_DISTINCT", "plans"))) == [(2,)]


def test_main_time_column():
    assert c.Roles(times=("a", "b")).time == "a"
    assert c.Roles(times=("a", "b"), main_time="b").time == "b"
    assert c.Roles().time is None


def test_trend_and_grain(dataset):
    assert [r[1] for r in rows(c.trend(dataset))] == [3, 1]
    hours = c.chart_query(dataset, [c.ROW_COUNT], x="t", grain="PT1H").orderBy("t")
    assert [(str(t), n) for t, n in rows(hours)] == [
        ("2024-01-01 10:00:00", 2), ("2024-01-01 11:00:00", 1), ("2024-01-02 09:00:00", 1),
    ]


def test_text_labels_can_be_bucketed(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 1), ("2024-01-01 11:00:00", 2)], "hour string, n int")
    assert [(str(t), n) for t, n in rows(c.chart_query(c.Dataset(df), [c.Metric.of("n")], x="hour", grain="P1D"))] == [
        ("2024-01-01 00:00:00", 3)
    ]


def test_stack_offsets(dataset):
    found = c.stacked_series(dataset, c.Metric.of("n"), "t", "plan", "P1D").orderBy("t", F.asc_nulls_last("plan"))
    assert [tuple(r)[1:] for r in found.collect()] == [("Free", 1, 1, 0), ("Pro", 5, 6, 1), (None, 4, 4, 0)]


def test_heatmap_scales_within_y(spark):
    df = spark.createDataFrame(
        [("f1", "Free", 10), ("f1", "Pro", 30), ("f1", "Max", 20), ("flat", "Free", 5), ("flat", "Pro", 5), (None, "Pro", 1)],
        "feature string, plan string, n int",
    )
    found = {(r["feature"], r["plan"]): r for r in c.heatmap(c.Dataset(df), c.Metric.of("n"), "plan", "feature").collect()}
    assert [found["f1", p]["scaled"] for p in ("Free", "Max", "Pro")] == [0.0, 0.5, 1.0]
    assert found["flat", "Free"]["scaled"] is None
    assert [found["f1", p]["x_position"] for p in ("Free", "Max", "Pro")] == [1, 2, 3]
    assert (found["f1", "Pro"]["y_position"], found["flat", "Pro"]["y_position"], found[None, "Pro"]["y_position"]) == (1, 2, 3)


def test_no_rows_are_left_out_unless_asked(spark):
    hours = spark.range(6000).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours="id")).alias("t"), F.col("id").alias("n"))
    line = c.Dataset(hours, c.Roles(times=("t",)))
    assert c.trend(line, grain="PT1H").count() == 6000
    assert c.chart_query(line, [c.ROW_COUNT], x="t", limit=5500).count() == 5500


def test_limits_come_after_offsets_and_scales(spark):
    df = spark.createDataFrame([("f", "a", 1), ("f", "b", 2), ("f", "c", 9), ("g", "a", 5)], "y string, x string, n int")
    cells = {(r.y, r.x): r for r in c.heatmap(c.Dataset(df), c.Metric.of("n"), "x", "y", limit=2).collect()}
    assert set(cells) == {("f", "c"), ("g", "a")} and cells["f", "c"].scaled == 1.0 and cells["f", "c"].x_position == 3
    pieces = c.stacked_series(c.Dataset(df), c.Metric.of("n"), "y", "x", limit=1).collect()
    assert [(r.stack_start, r.stack_end) for r in pieces] == [(3, 12)]


def test_shares(dataset):
    found = {r["plan"]: r["share"] for r in c.shares(dataset, c.Metric.of("n"), "plan").collect()}
    assert found == {"Free": 0.1, "Pro": 0.5, None: 0.4}


def test_filters_reach_the_scan(spark, work):
    spark.range(100).select("id", (F.col("id") % 5).cast("string").alias("plan")).write.parquet(work + "/p")
    dataset = c.Dataset(spark.read.parquet(work + "/p"))
    chart = c.chart_query(dataset.filtered({"plan": ["1"]}), [c.ROW_COUNT], ["plan"])
    plan = chart._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(plan,1)" in plan and "ReadSchema: struct<plan:string>" in plan
