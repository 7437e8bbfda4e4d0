"""Partial states of activity and bitmap counts against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bitmaps import distinct_counts, marked
from tidemark.operators.filters import Clock
from tidemark.streaming.states import ActivityStates

EVENTS = "event_id bigint, user_id bigint, session_id string, event_type string, event_time timestamp_ntz"
START = dt.datetime(2024, 3, 1)


def events(n=600, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = rng.choice([None, 1, 2, 3, 40_000, 70_000, rng.randrange(100_000)])
        session = None if i % 17 == 0 else f"s{rng.randrange(60)}"
        rows.append((i, user, session, rng.choice("ab"), START + dt.timedelta(minutes=rng.randrange(5 * 24 * 60), seconds=i % 60)))
    return rows


ROWS = events()


def counted(rows):
    distinct = lambda k: len({r[k] for r in rows} - {None})
    return len(rows), distinct(1), distinct(2)


def by(rows, key):
    groups = {}
    for r in rows:
        groups.setdefault(key(r), []).append(r)
    return {k: counted(g) for k, g in groups.items()}


hour_of = lambda r: r[4].strftime("%Y-%m-%d %H:00:00")
read = lambda df, key="hour": {r[key]: (r["events"], r["users"], r["sessions"]) for r in df.collect()}


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(ROWS, EVENTS).cache()


@pytest.mark.parametrize("roll_every", [0, 2])
def test_batches_out_of_order_and_again(spark, facts, tmp_path, roll_every):
    states = ActivityStates(spark, str(tmp_path), roll_every)
    order = ROWS[:]
    random.Random(1).shuffle(order)  # every batch has events of all days
    for number in range(5):
        part = spark.createDataFrame(order[number * 120 : (number + 1) * 120], EVENTS)
        states.append_batch(part, number)
        if number in (2, 4) and (number + 1) % (roll_every or 99):
            states.append_batch(part, number)  # a replay of the last batch
    assert read(states.counts(states.window(), F.col("hour"))) == by(ROWS, hour_of)
    assert {r["event_type"]: r["count"] for r in states.by_type().collect()} == {t: sum(r[3] == t for r in ROWS) for t in "ab"}
    assert states.version() == (3 if roll_every else -1)
    assert states.roll() == 4 and states.roll() == 4
    assert read(states.counts(states.window(), F.col("hour"))) == by(ROWS, hour_of)
    row = states.counts(states.window()).first()
    assert tuple(row) == counted(ROWS)
    numbers = [r["number"] for r in states._table("sessions").collect()]
    assert sorted(numbers) == list(range(len({r[2] for r in ROWS} - {None})))


@pytest.mark.parametrize("interval, length", [("1 HOURS", 1), ("30 HOURS", 30), ("72 HOURS", 72), ("9999 HOURS", 9999)])
def test_windows(spark, facts, tmp_path, interval, length):
    states = ActivityStates(spark, str(tmp_path))
    states.append_batch(facts, 0)
    now = max(r[4] for r in ROWS)
    inside = [r for r in ROWS if r[4] >= now - dt.timedelta(hours=length)]
    window = states.window(facts, interval, Clock.latest(facts, "event_time"))
    assert read(states.counts(window, F.to_date(F.substring("hour", 1, 10)), "day"), "day") == by(inside, lambda r: r[4].date())
    assert tuple(states.counts(window).first()) == counted(inside)
    fixed = states.window(facts, interval, Clock.at(now))
    assert tuple(states.counts(fixed).first()) == counted(inside)


def test_no_key_is_expanded(spark, facts, tmp_path):
    states = ActivityStates(spark, str(tmp_path))
    states.append_batch(facts, 0)
    plan = states.counts(states.window(facts, "30 HOURS", Clock.latest(facts, "event_time")))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap_or_agg" in plan


def test_nothing_stored(spark, facts, tmp_path):
    states = ActivityStates(spark, str(tmp_path))
    assert tuple(states.counts(states.window()).first()) == (0, 0, 0) and states.roll() == -1
    states.append_batch(facts.limit(0), 0)
    assert states.counts(states.window(), F.col("hour")).count() == 0


def test_bitmaps_of_far_and_negative_numbers(spark):
    rows = [("a", 0, None), ("a", 32767, 5), ("a", 32768, 5), ("a", 10**12, 6), ("b", -1, None), ("b", -1, None), ("c", None, None)]
    df = spark.createDataFrame(rows, "k string, x bigint, y int")
    found = distinct_counts(marked(df, ["k"], x="x", y="y"), ["k"], xs="x", ys="y")
    assert {r["k"]: (r["xs"], r["ys"]) for r in found.collect()} == {"a": (4, 2), "b": (1, 0)}
