"""Edges the given tables do not have: unmatched facts, repeated dimension keys, window borders, ties."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.filters import Clock, apply_filters, retain, since
from tidemark.operators.ranking import head_per_group, latest_per_key, top_k
from tidemark.plans import analytics as a
from tidemark.sources.schemas import STAR_SCHEMAS
from tidemark.sources.star import Star, load_star

NOW = dt.datetime(2024, 3, 31, 12, 0, 0)


def ago(**span):
    return NOW - dt.timedelta(**span)


def event(i, user, feature, campaign, session, kind, at):
    return (i, user, feature, campaign, session, kind, at, None, None, None)


def conversion(i, user, feature, campaign, kind, at, revenue):
    return (i, user, feature, campaign, kind, at, None, None, Decimal(revenue), None)


ROWS = {
    "dim_users": [
        (1, "a@x", "A", None, "Free", "DE", None, None),
        (2, "b@x", "B", None, "Pro", "US", None, None),
        (2, "b@x", "B", None, "Pro", "US", None, None),  # one key twice
    ],
    "dim_features": [(1, "Search", "Data", "", "Free"), (2, "Export", "Data", "", "Pro")],
    "dim_campaigns": [(1, "Mail", "Email", "letter", "email", None)],
    "fact_events": [
        event(1, 1, 1, 1, "s1", "feature_use", NOW),
        event(2, 1, 1, 1, "s1", "feature_use", ago(hours=1)),
        event(3, 2, 2, 1, "s2", "feature_use", ago(days=1)),
        event(4, 9, 1, 1, "s3", "feature_use", ago(days=1)),  # no such user
        event(5, 1, 2, 8, "s4", "page_view", ago(days=2)),  # no such campaign
        event(6, 1, None, None, "s5", "page_view", ago(days=2)),
        event(7, 1, 1, 1, "s6", "feature_use", ago(days=30)),  # on the border
        event(8, 1, 1, 1, "s7", "feature_use", ago(days=30, microseconds=1)),  # behind it
        event(9, 1, 1, 1, "s8", "feature_use", None),
    ],
    "fact_conversions": [
        conversion(1, 1, 1, 1, "signup", NOW, "10.00"),
        conversion(2, 2, 2, 1, "upgrade", ago(days=1), "5.50"),
        conversion(3, 9, 2, 1, "upgrade", ago(days=1), "100.00"),  # no such user
        conversion(4, 1, 1, 1, "signup", ago(days=31), "7.00"),
    ],
}


@pytest.fixture(scope="module")
def star(spark):
    return Star(**{name: spark.createDataFrame(rows, STAR_SCHEMAS[name]) for name, rows in ROWS.items()})


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_kpis_count_unmatched_facts(star):
    assert a.kpis(star).first().asDict() == {
        "active_users": 3,
        "total_events": 7,
        "total_sessions": 6,
        "total_conversions": 3,
        "total_revenue": 116.0,
    }


def test_kpis_of_an_empty_window(star):
    row = a.kpis(star, "1 HOUR", Clock.at("2030-01-01 00:00:00")).first()
    assert row["total_events"] == 0 and row["total_revenue"] is None


def test_inner_joins_filter_and_multiply(star):
    found = {r["activity_date"]: r for r in a.daily_activity(star).collect()}
    day = found[dt.date(2024, 3, 30)]
    # User 9 is dropped, user 2 is there twice.
    assert (day["events"], day["users"], day["sessions"]) == (2, 1, 1)
    assert dt.date(2024, 3, 29) not in found
    every = {r["activity_date"]: r["events"] for r in a.daily_activity_all(star).collect()}
    assert every[dt.date(2024, 3, 30)] == 2 and every[dt.date(2024, 3, 29)] == 2


def test_left_joins_keep_unmatched_facts(star):
    found = a.activity_summary(star)
    assert found.agg(F.sum("event_count")).first()[0] == 8  # 7 facts, one of them matched twice
    lost = found.where("plan IS NULL").collect()
    assert [(r["feature_name"], r["event_count"]) for r in lost] == [("Search", 1)]
    assert found.where("campaign_channel IS NULL").agg(F.sum("event_count")).first()[0] == 2


def test_repeated_user_counts_once_as_distinct(star):
    assert rows(a.feature_adoption(star), "plan", "feature_name", "users", "uses") == [
        ("Free", "Search", 1, 3),
        ("Pro", "Export", 1, 2),
    ]


def test_attribution_drops_unknown_users(star):
    assert rows(a.attribution(star), "feature_name", "conversions", "revenue") == [("Export", 2, 11.0), ("Search", 1, 10.0)]


def test_flow_has_both_halves(star):
    edges = {(r["source"], r["target"]): r["value"] for r in a.conversion_flow(star).collect()}
    assert edges == {
        ("Email", "Search"): 1,
        ("Email", "Export"): 2,
        ("Search", "signup"): 1,
        ("Export", "upgrade"): 2,
    }
    assert {r["target"] for r in a.conversion_flow(star, k=1).collect()} == {"Export", "upgrade"}


def test_widening_windows_change_nothing(star):
    plain = rows(a.recent_events(star, k=3), "event_id")
    assert plain == rows(a.recent_events(star, k=3, widen=("1 HOUR", "1 DAY", "30 DAYS")), "event_id")
    everything = rows(a.recent_events(star, k=50), "event_id")
    assert everything == rows(a.recent_events(star, k=50, widen=("1 HOUR",)), "event_id")
    assert everything[-1] == (9,)  # a fact without a time is the oldest


def test_since_border(star):
    kept = since(star.fact_events, "event_time", "30 DAYS", Clock.at(NOW))
    assert {r["event_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7}


def test_date_column_only_prunes(star):
    dated = star.fact_events.withColumn("event_date", F.to_date("event_time"))
    clock = Clock.latest(star.fact_events, "event_time")
    plain = since(dated, "event_time", "30 DAYS", clock)
    pruned = since(dated, "event_time", "30 DAYS", clock, "event_date")
    assert sorted(rows(plain, "event_id")) == sorted(rows(pruned, "event_id"))


def test_cutoff_reaches_the_reader(spark, star, work):
    star.fact_events.withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(work + "/f")
    facts = spark.read.parquet(work + "/f")
    kept = since(facts, "event_time", "1 DAYS", Clock.at(NOW), "event_date")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and kept.count() == 4


def test_retention_border(star):
    kept = retain(star.fact_events, "event_time", 2, Clock.at(NOW))
    assert {r["event_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6}


def test_ties_at_the_cut(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "name string, n int")
    assert rows(top_k(df, 2, F.desc("n"), F.asc("name")), "name") == [("c",), ("a",)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (2, 2, "z")], "k int, seq int, v string")
    assert sorted(rows(latest_per_key(df, ["k"], F.desc("seq")), "k", "v")) == [(1, "y"), (2, "z")]
    assert head_per_group(df, ["k"], 2, [F.desc("seq")]).count() == 3


def test_hot_group_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_per_key(df, ["k"], F.desc("id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_filters_skip_other_datasets(spark):
    df = spark.createDataFrame([("Free", 1), ("Pro", 2)], "plan string, n int")
    assert apply_filters(df, {"plan": ["Pro"], "country": ["US"]}).count() == 1


def test_load_star_views(spark, star, work):
    for name, df in star.tables().items():
        df.write.parquet(f"{work}/{name}.parquet")
    loaded = load_star(spark, work)
    assert spark.table("fact_events").count() == len(ROWS["fact_events"])
    assert dict(loaded.fact_conversions.dtypes)["revenue"] == "decimal(10,2)"


def test_star_needs_all_tables():
    with pytest.raises(ValueError, match="dim_users"):
        Star(fact_events=None)


def test_dated_facts_give_the_same_kpis(star):
    dated = star.replace(
        fact_events=star.fact_events.withColumn("event_date", F.to_date("event_time")),
        fact_conversions=star.fact_conversions.withColumn("event_date", F.to_date("conversion_time")),
    )
    assert a.kpis(dated, "1 DAY").first() == a.kpis(star, "1 DAY").first()
    for k in (3, 100):
        assert a.recent_events(dated, k=k).collect() == a.recent_events(star, k=k).collect()


def test_windows_prune_dated_facts_through_the_loader(spark, work):
    from tidemark.sources.star import star_from_shop
    from tidemark.sources.writers import write_dated

    for name, df in star_from_shop(spark, "/root/testdata/sf0.001").tables().items():
        if name.startswith("fact_"):
            write_dated(df, f"{work}/{name}.parquet", "event_time" if name == "fact_events" else "conversion_time")
        else:
            df.write.parquet(f"{work}/{name}.parquet")
    dated = load_star(spark, work, views=False)
    plain = star_from_shop(spark, "/root/testdata/sf0.001")
    assert "event_date" in dated.fact_events.columns
    for query in (a.kpis, a.hourly_activity, a.daily_activity, a.activity_by_plan, a.top_features, a.conversion_flow, a.attribution):
        found = query(dated, window="7 DAYS")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(event_date" in plan, query.__name__
        assert sorted(map(str, found.collect())) == sorted(map(str, query(plain, window="7 DAYS").collect()))


def test_a_missing_key_column_stops_the_load(spark):
    from tidemark.sources.schemas import conform

    with pytest.raises(ValueError, match="event_id"):
        conform(spark.sql("SELECT 1 AS id"), "fact_events")
