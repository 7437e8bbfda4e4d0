"""Chart queries over the named datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import stacked
from ..plans import analytics as a, charts as c
from ..sources.star import Star
from . import analytics as sql
from .base import STAR
from .expressions import star_query


def events_dataset(star: Star) -> c.Dataset:
    return c.Dataset(star.fact_events, c.STAR_ROLES["fact_events"])


def conversions_dataset(star: Star) -> c.Dataset:
    return c.Dataset(star.fact_conversions, c.STAR_ROLES["fact_conversions"])


def inner(text: str) -> str:
    """A named dataset's SQL as a derived table."""
    return f"({text})"


DAY = "strftime(date_trunc('day', {}), '%Y-%m-%d %H:%M:%S.%f')"


@star_query("bi_1", f"SELECT {DAY.format('event_time')} AS event_time, count(*) AS count FROM fact_events GROUP BY 1")
def bi_1(star: Star):
    return c.trend(events_dataset(star))


@star_query(
    "bi_2",
    """SELECT plan, event_type, count(*) AS count, count(DISTINCT e.user_id) AS users
    FROM fact_events e JOIN dim_users u ON e.user_id = u.user_id GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 12""",
)
def bi_2(star: Star):
    named = star.fact_events.join(star.dim_users.select("user_id", "plan"), "user_id")
    metrics = [c.ROW_COUNT, c.Metric.of("user_id", "COUNT_DISTINCT", "users")]
    return c.chart_query(c.Dataset(named), metrics, ["plan", "event_type"], limit=12)


@star_query(
    "bi_3",
    f"""SELECT CAST(max(active_users) AS BIGINT) AS active_users, CAST(max(total_events) AS BIGINT) AS total_events,
    CAST(sum(total_conversions) AS BIGINT) AS total_conversions FROM {inner(sql._kpis("30 DAYS"))}""",
)
def bi_3(star: Star):
    metrics = [c.Metric.of("active_users", "MAX"), c.Metric.of("total_events", "MAX"), c.Metric.of("total_conversions", "SUM")]
    return c.chart_query(c.Dataset(a.kpis(star)), metrics)


@star_query(
    "bi_4",
    """SELECT conversion_type, CAST(round(sum(revenue), 0) AS DOUBLE) AS revenue, count(*) AS conversions
    FROM fact_conversions GROUP BY 1""",
)
def bi_4(star: Star):
    metrics = [c.Metric.sql("ROUND(SUM(revenue), 0)", "revenue"), c.Metric.sql("COUNT(*)", "conversions")]
    return c.chart_query(conversions_dataset(star), metrics, ["conversion_type"])


@star_query(
    "bi_5",
    f"""SELECT 'P1D' AS grain, {DAY.format("event_time")} AS event_time, count(*) AS count FROM fact_events GROUP BY 2
    UNION ALL SELECT 'PT1H', {DAY.format("event_time").replace("'day'", "'hour'")}, count(*) FROM fact_events GROUP BY 2""",
)
def bi_5(star: Star):
    charts = [
        c.chart_query(events_dataset(star), [c.ROW_COUNT], x="event_time", grain=g).withColumn("grain", F.lit(g))
        for g in ("P1D", "PT1H")
    ]
    return stacked(charts)


@star_query(
    "bi_6",
    f"""SELECT strftime(CAST(activity_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS activity_date, plan,
    CAST(v AS BIGINT) AS users, CAST(e AS BIGINT) AS stack_end, CAST(e - v AS BIGINT) AS stack_start
    FROM (SELECT *, sum(v) OVER (PARTITION BY activity_date ORDER BY plan) AS e
      FROM (SELECT activity_date, plan, sum(users) AS v FROM {inner(sql._plan("30 DAYS"))} GROUP BY 1, 2))
    ORDER BY v DESC, activity_date, plan LIMIT 200""",
)
def bi_6(star: Star):
    dataset = c.Dataset(a.activity_by_plan(star))
    return c.stacked_series(dataset, c.Metric.of("users"), "activity_date", "plan", "P1D", 200)


@star_query(
    "bi_7",
    f""", h AS {inner(sql.HEATMAP_SQL)},
    cells AS (SELECT plan, feature_name, sum(usage_count) AS v FROM h GROUP BY 1, 2),
    ys AS (SELECT feature_name, min(v) AS low, max(v) AS high,
      row_number() OVER (ORDER BY sum(v) DESC, feature_name) AS y_position FROM cells GROUP BY 1),
    xs AS (SELECT plan, row_number() OVER (ORDER BY plan) AS x_position FROM (SELECT DISTINCT plan FROM cells))
    SELECT cells.plan, cells.feature_name, CAST(v AS BIGINT) AS usage, round(CAST((v - low) AS DOUBLE) / nullif(high - low, 0), 9) AS scaled,
    x_position, y_position FROM cells JOIN ys ON ys.feature_name = cells.feature_name JOIN xs ON xs.plan = cells.plan""",
)
def bi_7(star: Star):
    dataset = c.Dataset(a.feature_heatmap(star))
    cells = c.heatmap(dataset, c.Metric.sql("SUM(usage_count)", "usage"), "plan", "feature_name")
    return cells.withColumn("scaled", F.round("scaled", 9))


@star_query(
    "bi_8",
    f""", edges AS (SELECT * FROM ({STAR} {sql._sankey("30 DAYS")}))
    SELECT source, target, CAST(sum(value) AS BIGINT) AS flow FROM edges GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 100""",
)
def bi_8(star: Star):
    dataset = c.Dataset(a.conversion_flow(star))
    return c.chart_query(dataset, [c.Metric.sql("SUM(value)", "flow")], ["source", "target"], limit=100)


@star_query(
    "bi_9",
    f"""SELECT channel, source, feature_name, conversion_type, CAST(sum(conversions) AS BIGINT) AS conversions,
    round(sum(revenue), 0) AS revenue FROM {inner(sql._attr("30 DAYS"))}
    GROUP BY 1, 2, 3, 4 ORDER BY 5 DESC, 1, 2, 3, 4 LIMIT 25""",
)
def bi_9(star: Star):
    metrics = [c.Metric.sql("SUM(conversions)", "conversions"), c.Metric.sql("ROUND(SUM(revenue), 0)", "revenue")]
    keys = ["channel", "source", "feature_name", "conversion_type"]
    return c.chart_query(c.Dataset(a.attribution(star)), metrics, keys, limit=25)


@star_query(
    "bi_10",
    f"""SELECT {DAY.format("conversion_time")} AS conversion_time, CAST(sum(revenue) AS DOUBLE) AS revenue
    FROM fact_conversions GROUP BY 1
    UNION ALL SELECT NULL, CAST(sum(revenue) AS DOUBLE) FROM fact_conversions""",
)
def bi_10(star: Star):
    dataset, metric = conversions_dataset(star), c.Metric.of("revenue")
    whole = c.big_number(dataset, metric).withColumn("conversion_time", F.lit(None).cast("timestamp_ntz"))
    return c.trend(dataset, metric).unionByName(whole)


@star_query(
    "bi_11",
    f"""SELECT plan, CAST(sum(event_count) AS BIGINT) AS event_count,
    round(CAST(sum(event_count) AS DOUBLE) / sum(sum(event_count)) OVER (), 9) AS share
    FROM {inner(sql.SUMMARY_SQL)} GROUP BY 1""",
)
def bi_11(star: Star):
    parts = c.shares(c.Dataset(a.activity_summary(star)), c.Metric.of("event_count"), "plan")
    return parts.withColumn("share", F.round("share", 9))


@star_query(
    "bi_12",
    f"""SELECT plan, feature_name, CAST(sum(unique_users) AS BIGINT) AS unique_users FROM {inner(sql.SUMMARY_SQL)}
    GROUP BY 1, 2""",
)
def bi_12(star: Star):
    # Sums a distinct count over finer groups, as that chart is defined; it is not a distinct count itself.
    dataset = c.Dataset(a.activity_summary(star))
    return c.chart_query(dataset, [c.Metric.of("unique_users")], ["plan", "feature_name"])


@star_query(
    "bi_13",
    f"""SELECT 'heatmap' AS dataset, CAST(sum(usage_count) AS BIGINT) AS value FROM {inner(sql._heat_recent("30 DAYS"))}
      WHERE plan IN ('BUILDING', 'MACHINERY')
    UNION ALL SELECT 'trend', CAST(sum(users) AS BIGINT) FROM {inner(sql._plan("30 DAYS"))}
      WHERE plan IN ('BUILDING', 'MACHINERY')
    UNION ALL SELECT 'types', count(*) FROM fact_events""",
)
def bi_13(star: Star):
    selected = {"plan": ["BUILDING", "MACHINERY"]}
    datasets = {
        "heatmap": (a.feature_heatmap_recent(star), "usage_count"),
        "trend": (a.activity_by_plan(star), "users"),
        "types": (a.event_types(star), "count"),
    }
    return stacked(
        [
            c.big_number(c.Dataset(df).filtered(selected), c.Metric.of(column, label="value")).select(
                F.lit(name).alias("dataset"), "value"
            )
            for name, (df, column) in datasets.items()
        ]
    )


@star_query(
    "bi_14",
    "SELECT user_id, session_id, count(*) AS count FROM fact_events GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5000",
)
def bi_14(star: Star):
    return c.chart_query(events_dataset(star), [c.ROW_COUNT], ["user_id", "session_id"], limit=c.TABLE_ROWS)


@star_query("bi_15", f"SELECT hour, CAST(events AS BIGINT) AS events, CAST(users AS BIGINT) AS users FROM {inner(sql._hourly('24 HOURS'))}")
def bi_15(star: Star):
    """Line over the hours as labels, with two metrics."""
    return c.chart_query(c.Dataset(a.hourly_activity(star)), [c.Metric.of("events"), c.Metric.of("users")], x="hour")


@star_query(
    "bi_16",
    f"""SELECT activity_date, CAST(users AS BIGINT) AS users, CAST(events AS BIGINT) AS events, CAST(sessions AS BIGINT) AS sessions
    FROM {inner(sql._daily("30 DAYS", sql._DAILY_JOINS))}""",
)
def bi_16(star: Star):
    """Area over the days, with three metrics."""
    metrics = [c.Metric.of("users"), c.Metric.of("events"), c.Metric.of("sessions")]
    return c.chart_query(c.Dataset(a.daily_activity(star)), metrics, x="activity_date")


@star_query("bi_17", f"SELECT feature_name, CAST(total_uses AS BIGINT) AS total_uses FROM {inner(sql._topfeat('30 DAYS'))}")
def bi_17(star: Star):
    """Bars of the ten most used features."""
    return c.chart_query(c.Dataset(a.top_features(star)), [c.Metric.of("total_uses")], ["feature_name"], limit=10)


@star_query("bi_18", f"SELECT CAST(total_sessions AS BIGINT) AS total_sessions, total_revenue FROM {inner(sql._kpis('30 DAYS'))}")
def bi_18(star: Star):
    """The big numbers of sessions and revenue."""
    return c.chart_query(c.Dataset(a.kpis(star)), [c.Metric.of("total_sessions", "MAX"), c.Metric.of("total_revenue", "MAX")])
