"""Dashboard and report queries over a :class:`~tidemark.sources.star.Star`.

Facts are tallied on their foreign keys before they meet a dimension, and inner joins are kept even when no column
of the dimension is used, because an unmatched fact must not be counted. No broadcast is forced: Catalyst
broadcasts a dimension when its size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.times import hour_label
from ..functions.values import rounded_sum
from ..operators.activity import count_by, tally
from ..operators.filters import Clock, since
from ..operators.ranking import top_k
from ..session import checkpointed
from ..sources.star import Star
from ..streaming.states import ActivityStates

USE = "feature_use"


def clock_of(star: Star) -> Clock:
    """Default "now": the latest event."""
    return Clock.latest(star.fact_events, "event_time", _day(star.fact_events))


def _events(star: Star, window: str | None, clock: Clock | None) -> DataFrame:
    if window is None:
        return star.fact_events
    return since(star.fact_events, "event_time", window, clock or clock_of(star), _day(star.fact_events))


def _conversions(star: Star, window: str | None, clock: Clock | None) -> DataFrame:
    if window is None:
        return star.fact_conversions
    return since(
        star.fact_conversions, "conversion_time", window, clock or clock_of(star), _day(star.fact_conversions)
    )


def _day(facts: DataFrame) -> str | None:
    return "event_date" if "event_date" in facts.columns else None


def kpis(star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    """One row of headline numbers; each fact table is scanned once."""
    events = _events(star, window, clock).agg(
        F.count_distinct("user_id").alias("active_users"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("session_id").alias("total_sessions"),
    )
    activity = events.select(F.struct("*").alias("activity")).scalar()
    conversions = _conversions(star, window, clock).agg(
        F.count(F.lit(1)).alias("total_conversions"), rounded_sum("revenue", 0).alias("total_revenue")
    )
    return conversions.withColumn("activity", activity).select(
        "activity.*", "total_conversions", "total_revenue"
    )


def hourly_activity(star: Star, window: str = "24 HOURS", clock: Clock | None = None) -> DataFrame:
    return (
        _events(star, window, clock)
        .groupBy(hour_label("event_time").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("user_id").alias("users"),
            F.count_distinct("session_id").alias("sessions"),
        )
        .orderBy("hour")
    )


def kpis_from(states: ActivityStates, star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    """``kpis`` with the activity merged from stored states."""
    clock = clock or clock_of(star)
    merged = states.counts(states.window(star.fact_events, window, clock))
    activity = merged.select(
        F.struct(F.col("users").alias("active_users"), F.col("events").alias("total_events"), F.col("sessions").alias("total_sessions")).alias("activity")
    ).scalar()
    conversions = _conversions(star, window, clock).agg(
        F.count(F.lit(1)).alias("total_conversions"), rounded_sum("revenue", 0).alias("total_revenue")
    )
    return conversions.withColumn("activity", activity).select("activity.*", "total_conversions", "total_revenue")


def hourly_from(states: ActivityStates, star: Star, window: str = "24 HOURS", clock: Clock | None = None) -> DataFrame:
    """``hourly_activity`` from stored states."""
    states_in = states.window(star.fact_events, window, clock or clock_of(star))
    return states.counts(states_in, F.col("hour"), "hour").orderBy("hour")


def daily_all_from(states: ActivityStates, star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    """``daily_activity_all`` from stored states."""
    states_in = states.window(star.fact_events, window, clock or clock_of(star))
    return states.counts(states_in, F.to_date(F.substring("hour", 1, 10)), "activity_date").orderBy("activity_date")


def daily_activity(star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    """Per day, over events whose user and campaign exist."""
    facts = tally(
        _events(star, window, clock),
        [F.to_date("event_time").alias("activity_date"), "user_id", "session_id", "campaign_id"],
    )
    joined = facts.join(star.dim_users.select("user_id"), "user_id").join(
        star.dim_campaigns.select("campaign_id"), "campaign_id"
    )
    return _daily(joined, F.sum("n"))


def daily_activity_all(star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    """Per day, over all events."""
    facts = _events(star, window, clock).withColumn("activity_date", F.to_date("event_time"))
    return _daily(facts, F.count(F.lit(1)))


def _daily(facts: DataFrame, events) -> DataFrame:
    return (
        facts.groupBy("activity_date")
        .agg(
            F.count_distinct("user_id").alias("users"),
            events.alias("events"),
            F.count_distinct("session_id").alias("sessions"),
        )
        .orderBy("activity_date")
    )


def activity_by_plan(star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    facts = (
        _events(star, window, clock).select(F.to_date("event_time").alias("activity_date"), "user_id").distinct()
    )
    return (
        facts.join(star.dim_users.select("user_id", "plan"), "user_id")
        .groupBy("activity_date", "plan")
        .agg(F.count_distinct("user_id").alias("users"))
        .orderBy("activity_date", F.asc_nulls_last("plan"))
    )


def top_features(star: Star, window: str = "30 DAYS", clock: Clock | None = None, k: int = 10) -> DataFrame:
    """Most used features by name."""
    uses = tally(_events(star, window, clock).where(F.col("event_type") == USE), ["feature_id", "user_id"])
    named = uses.join(star.dim_features.select("feature_id", "feature_name"), "feature_id")
    counted = named.groupBy("feature_name").agg(
        F.sum("n").alias("total_uses"), F.count_distinct("user_id").alias("unique_users")
    )
    return top_k(counted, k, F.desc("total_uses"), F.asc_nulls_last("feature_name"))


def feature_adoption(star: Star, window: str = "30 DAYS", clock: Clock | None = None, k: int = 50) -> DataFrame:
    """Users and uses per plan and feature, most used first."""
    uses = tally(_events(star, window, clock).where(F.col("event_type") == USE), ["user_id", "feature_id"])
    joined = uses.join(star.dim_users.select("user_id", "plan"), "user_id").join(
        star.dim_features.select("feature_id", "feature_name"), "feature_id"
    )
    counted = joined.groupBy("plan", "feature_name").agg(
        F.count_distinct("user_id").alias("users"), F.sum("n").alias("uses")
    )
    return top_k(counted, k, F.desc("uses"), F.asc_nulls_last("plan"), F.asc_nulls_last("feature_name"))


def feature_heatmap(star: Star, k: int = 5) -> DataFrame:
    """Use by feature name and plan for the ``k`` most used features; all types, all time.

    The first pass reads feature ids only; the second keeps the ``k`` features before anything is shuffled.
    """
    totals = tally(star.fact_events, ["feature_id"])
    top = top_k(totals, k, F.desc("n"), F.asc_nulls_last("feature_id")).select("feature_id")
    kept = star.fact_events.join(top, "feature_id", "left_semi")
    return _by_feature_and_plan(star, tally(kept, ["user_id", "feature_id"]))


def feature_heatmap_recent(star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    """Use by feature name and plan for all features in the window."""
    return _by_feature_and_plan(star, tally(_events(star, window, clock), ["user_id", "feature_id"]))


def _by_feature_and_plan(star: Star, uses: DataFrame) -> DataFrame:
    return (
        uses.join(star.dim_users.select("user_id", "plan"), "user_id")
        .join(star.dim_features.select("feature_id", "feature_name"), "feature_id")
        .groupBy("feature_name", "plan")
        .agg(F.sum("n").alias("usage_count"))
    )


def conversion_counts(star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    """Conversions per channel, feature name and type."""
    facts = tally(_conversions(star, window, clock), ["campaign_id", "feature_id", "conversion_type"])
    return (
        facts.join(star.dim_campaigns.select("campaign_id", "channel"), "campaign_id")
        .join(star.dim_features.select("feature_id", "feature_name"), "feature_id")
        .groupBy("channel", "feature_name", "conversion_type")
        .agg(F.sum("n").alias("conversions"))
    )


def conversion_flow(
    star: Star, window: str = "30 DAYS", clock: Clock | None = None, k: int = 5
) -> DataFrame:
    """Edges channel to feature and feature to conversion type, for the ``k`` most converting features."""
    counts = conversion_counts(star, window, clock)
    totals = counts.groupBy("feature_name").agg(F.sum("conversions").alias("total"))
    top = top_k(totals, k, F.desc("total"), F.asc_nulls_last("feature_name")).select("feature_name")
    kept = counts.join(top, "feature_name", "left_semi")

    def edges(source: str, target: str) -> DataFrame:
        return kept.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(
            F.sum("conversions").alias("value")
        )

    return edges("channel", "feature_name").unionByName(edges("feature_name", "conversion_type"))


def attribution(star: Star, window: str = "30 DAYS", clock: Clock | None = None, k: int = 30) -> DataFrame:
    """Conversions and revenue per channel, source, feature and type; the user join only filters."""
    facts = tally(
        _conversions(star, window, clock),
        ["user_id", "campaign_id", "feature_id", "conversion_type"],
        revenue="revenue",
    )
    joined = (
        facts.join(star.dim_users.select("user_id"), "user_id")
        .join(star.dim_campaigns.select("campaign_id", "channel", "source"), "campaign_id")
        .join(star.dim_features.select("feature_id", "feature_name"), "feature_id")
    )
    keys = ["channel", "source", "feature_name", "conversion_type"]
    counted = joined.groupBy(*keys).agg(
        F.sum("n").alias("conversions"), rounded_sum("revenue", 2).alias("revenue")
    )
    return top_k(counted, k, F.desc_nulls_last("revenue"), *[F.asc_nulls_last(c) for c in keys])


# Windows tried for a feed over a dated table, where a window opens few day folders.
FEED_WINDOWS = ("1 DAY", "7 DAYS")
FEED_HEADS = (4, 64)


def _latest_matched(
    facts: DataFrame, ts: str, key: str, k: int, join, widen: tuple[str, ...] | None
) -> DataFrame:
    """The latest ``k`` facts that survive ``join``.

    The facts are cut before they meet a dimension: to growing spans behind the latest fact (``widen``; by default for a
    dated table, where they prune day folders), then to the latest few times ``k``. Once a part holds ``k`` matches, no older
    fact can belong to the result; when none does, the whole table is joined. Each part is evaluated once, kept by a
    checkpoint of at most ``k`` rows.
    """
    if widen is None:
        widen = FEED_WINDOWS if _day(facts) else ()
    order = [F.desc_nulls_last(ts), F.desc_nulls_last(key)]
    spans = [since(facts, ts, interval, Clock.latest(facts, ts, _day(facts)), _day(facts)) for interval in widen]
    for part in [*spans, *[top_k(facts, k * times, *order) for times in FEED_HEADS]]:
        head = checkpointed(facts.sparkSession, top_k(join(part), k, *order))
        if head.count() == k:
            return head
    return top_k(join(facts), k, *order)


def recent_conversions(star: Star, k: int = 50, widen: tuple[str, ...] | None = None) -> DataFrame:
    users = star.dim_users.select("user_id", "email", "plan")
    campaigns = star.dim_campaigns.select("campaign_id", "campaign_name", "channel")
    head = _latest_matched(
        star.fact_conversions,
        "conversion_time",
        "conversion_id",
        k,
        lambda facts: facts.join(users, "user_id").join(campaigns, "campaign_id"),
        widen,
    )
    return head.select(
        "conversion_time", "email", "plan", "conversion_type", "revenue", "campaign_name", "channel"
    )


def recent_events(star: Star, k: int = 100, widen: tuple[str, ...] | None = None) -> DataFrame:
    users = star.dim_users.select("user_id", "email", "name", "plan")
    features = star.dim_features.select("feature_id", "feature_name")
    head = _latest_matched(
        star.fact_events,
        "event_time",
        "event_id",
        k,
        lambda facts: facts.join(users, "user_id").join(features, "feature_id"),
        widen,
    )
    return head.select(
        "event_id", "event_time", "email", "name", "plan", "feature_name", "event_type", "session_id"
    )


def activity_summary(star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    """The wide summary dataset; facts without a matching dimension row stay, with null attributes."""
    facts = tally(
        _events(star, window, clock),
        [
            F.to_date("event_time").alias("event_date"),
            F.hour("event_time").cast("bigint").alias("event_hour"),
            "event_type",
            "user_id",
            "feature_id",
            "campaign_id",
            "session_id",
        ],
    )
    users = star.dim_users.select("user_id", "plan", "country")
    features = star.dim_features.select("feature_id", "feature_name", F.col("category").alias("feature_category"))
    campaigns = star.dim_campaigns.select("campaign_id", F.col("channel").alias("campaign_channel"))
    return (
        facts.join(users, "user_id", "left")
        .join(features, "feature_id", "left")
        .join(campaigns, "campaign_id", "left")
        .groupBy(
            "event_date",
            "event_hour",
            "plan",
            "country",
            "feature_name",
            "feature_category",
            "campaign_channel",
            "event_type",
        )
        .agg(
            F.sum("n").alias("event_count"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_distinct("session_id").alias("sessions"),
        )
    )


def activity_per_plan(star: Star, window: str = "7 DAYS", clock: Clock | None = None) -> DataFrame:
    facts = tally(_events(star, window, clock), ["user_id", "session_id"])
    return (
        facts.join(star.dim_users.select("user_id", "plan"), "user_id")
        .groupBy("plan")
        .agg(
            F.count_distinct("user_id").alias("users"),
            F.sum("n").alias("events"),
            F.count_distinct("session_id").alias("sessions"),
        )
        .orderBy(F.desc("events"), F.asc_nulls_last("plan"))
    )


def conversion_funnel(star: Star, window: str = "30 DAYS", clock: Clock | None = None) -> DataFrame:
    total = F.sum("revenue").cast("double")
    return (
        _conversions(star, window, clock)
        .groupBy("conversion_type")
        .agg(
            F.count(F.lit(1)).alias("conversions"),
            total.alias("total_revenue"),
            (total / F.count("revenue")).alias("avg_revenue"),
        )
        .orderBy(F.desc("conversions"), F.asc_nulls_last("conversion_type"))
    )


def feature_usage_by_plan(star: Star, window: str = "7 DAYS", clock: Clock | None = None) -> DataFrame:
    uses = tally(_events(star, window, clock), ["user_id", "feature_id"])
    return (
        uses.join(star.dim_users.select("user_id", "plan"), "user_id")
        .join(star.dim_features.select("feature_id", "feature_name", "tier_required"), "feature_id")
        .groupBy("plan", "feature_name", "tier_required")
        .agg(F.sum("n").alias("usage_count"))
        .orderBy(F.asc_nulls_last("plan"), F.desc("usage_count"), "feature_name", "tier_required")
    )


def event_types(star: Star) -> DataFrame:
    return count_by(star.fact_events, ["event_type"], "count").orderBy(
        F.desc("count"), F.asc_nulls_last("event_type")
    )


def revenue_by_type(star: Star) -> DataFrame:
    return (
        star.fact_conversions.groupBy("conversion_type")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("revenue").cast("double").alias("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("conversion_type"))
    )


# Name to query; what a dashboard refresh or a materialisation run walks over.
NAMED = {
    "kpis": kpis,
    "hourly_activity": hourly_activity,
    "daily_activity": daily_activity,
    "daily_activity_all": daily_activity_all,
    "activity_by_plan": activity_by_plan,
    "top_features": top_features,
    "feature_adoption": feature_adoption,
    "feature_heatmap": feature_heatmap,
    "feature_heatmap_recent": feature_heatmap_recent,
    "conversion_flow": conversion_flow,
    "attribution": attribution,
    "recent_conversions": recent_conversions,
    "recent_events": recent_events,
    "activity_summary": activity_summary,
    "activity_per_plan": activity_per_plan,
    "conversion_funnel": conversion_funnel,
    "feature_usage_by_plan": feature_usage_by_plan,
    "event_types": event_types,
    "revenue_by_type": revenue_by_type,
}
