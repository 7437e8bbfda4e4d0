"""Filters, projections, scalar functions, joins, aggregates, ranks, sorts and set operations, each on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import times, texts, values, vectors
from ..operators.activity import count_by, high_water_mark, tally
from ..operators.filters import Clock, since
from ..operators.ids import assign_ids
from ..operators.quality import stacked
from ..operators.ranking import ranked_head, top_k
from ..operators.retrieval import fused_score, keyword_candidates, nearest
from ..plans.analytics import clock_of, conversion_counts
from ..sources.star import Star, raw, star_from_shop
from .base import NOW, STAR, query, stamp
from .retrieval import (
    DOCS_SQL,
    QUERY_WORDS,
    QV_SQL,
    TEXTS_SQL,
    all_texts,
    any_term_sql,
    cosine_sql,
    documents_with_vectors,
    query_vector,
    text_list_sql,
    texts_only,
    vector_list_sql,
)


def star_query(name: str, sql: str):
    """Register a query over the star; ``sql`` goes behind the star's table expressions."""

    def keep(fn):
        query(name, STAR + sql)(lambda spark, directory: fn(star_from_shop(spark, directory)))
        return fn

    return keep


# -- filters ----------------------------------------------------------------------------------------------


@star_query(
    "fl_1",
    " UNION ALL ".join(
        f"SELECT '{i}' AS span, count(*) AS events FROM fact_events WHERE event_time >= {NOW} - INTERVAL {i}"
        for i in ("1 HOUR", "24 HOURS", "7 DAYS", "30 DAYS")
    ),
)
def fl_1(star: Star) -> DataFrame:
    spans = ("1 HOUR", "24 HOURS", "7 DAYS", "30 DAYS")
    return stacked(
        [
            since(star.fact_events, "event_time", s, clock_of(star))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.lit(s).alias("span"), "events")
            for s in spans
        ]
    )


@star_query(
    "fl_2",
    f"""SELECT event_id, user_id FROM fact_events
    WHERE event_type = 'feature_use' AND event_time >= {NOW} - INTERVAL 7 DAYS""",
)
def fl_2(star: Star) -> DataFrame:
    recent = since(star.fact_events, "event_time", "7 DAYS", clock_of(star))
    return recent.where(F.col("event_type") == "feature_use").select("event_id", "user_id")


@star_query("fl_3", "SELECT user_id, email, name, plan FROM dim_users WHERE email = 'user7@example.com'")
def fl_3(star: Star) -> DataFrame:
    return star.dim_users.where(F.col("email") == "user7@example.com").select("user_id", "email", "name", "plan")


_TOP_FEATURES = "SELECT feature_id FROM fact_events GROUP BY 1 ORDER BY count(*) DESC, feature_id LIMIT 5"


def _top_feature_ids(star: Star) -> DataFrame:
    counted = count_by(star.fact_events, ["feature_id"], "uses")
    return top_k(counted, 5, F.desc("uses"), F.asc("feature_id")).select("feature_id")


@star_query("fl_4", f"SELECT event_id, feature_id FROM fact_events WHERE feature_id IN ({_TOP_FEATURES})")
def fl_4(star: Star) -> DataFrame:
    return star.fact_events.join(_top_feature_ids(star), "feature_id", "left_semi").select("event_id", "feature_id")


@query("fl_5", f"SELECT doc_id AS id FROM documents WHERE {any_term_sql('text', QUERY_WORDS)}")
def fl_5(spark, directory):
    return texts_only(spark, directory).where(texts.match_any("content", QUERY_WORDS)).select("id")


@query(
    "fl_6",
    """SELECT doc_id, count(*) FILTER (regexp_matches(line, '\\S')) AS kept, count(*) AS lines
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""",
)
def fl_6(spark, directory):
    lines = all_texts(spark, directory).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(
        F.count_if(texts.not_blank("line")).alias("kept"), F.count(F.lit(1)).alias("lines")
    )


@star_query("pr_1", "SELECT 'feature' AS kind, feature_id AS id, feature_name AS label FROM dim_features")
def pr_1(star: Star) -> DataFrame:
    return star.dim_features.select(
        F.lit("feature").alias("kind"), F.col("feature_id").alias("id"), F.col("feature_name").alias("label")
    )


# -- scalar functions -------------------------------------------------------------------------------------


@star_query("sc_1", "SELECT event_id, CAST(CAST(event_time AS DATE) AS VARCHAR) AS day FROM fact_events")
def sc_1(star: Star) -> DataFrame:
    return star.fact_events.select("event_id", F.to_date("event_time").alias("day"))


@star_query("sc_2", "SELECT event_id, CAST(hour(event_time) AS INTEGER) AS hour FROM fact_events")
def sc_2(star: Star) -> DataFrame:
    return star.fact_events.select("event_id", F.hour("event_time").alias("hour"))


@star_query(
    "sc_3",
    f"""SELECT event_id, {stamp("event_time - INTERVAL 30 DAYS")} AS month_before,
    {stamp("event_time - INTERVAL 24 HOURS")} AS day_before FROM fact_events""",
)
def sc_3(star: Star) -> DataFrame:
    at = F.col("event_time")
    return star.fact_events.select(
        "event_id",
        (at - times.span("30 DAYS")).alias("month_before"),
        (at - times.span("24 HOURS")).alias("day_before"),
    )


@star_query("sc_4", "SELECT event_id, strftime(event_time, '%Y-%m-%d %H:00:00') AS hour FROM fact_events")
def sc_4(star: Star) -> DataFrame:
    return star.fact_events.select("event_id", times.hour_label("event_time").alias("hour"))


@star_query(
    "sc_5",
    """SELECT user_id, CAST(round(sum(revenue), 0) AS DOUBLE) AS whole, CAST(round(sum(revenue), 2) AS DOUBLE) AS cents
    FROM fact_conversions GROUP BY 1""",
)
def sc_5(star: Star) -> DataFrame:
    return star.fact_conversions.groupBy("user_id").agg(
        values.rounded_sum("revenue", 0).alias("whole"), values.rounded_sum("revenue", 2).alias("cents")
    )


@star_query(
    "sc_6",
    """SELECT u.user_id, coalesce(c.n, 0) AS conversions, coalesce(c.top, 999) AS top
    FROM dim_users u LEFT JOIN (SELECT user_id, count(*) AS n, max(feature_id) AS top FROM fact_conversions GROUP BY 1) c
    ON u.user_id = c.user_id""",
)
def sc_6(star: Star) -> DataFrame:
    done = star.fact_conversions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("feature_id").alias("top")
    )
    return star.dim_users.join(done, "user_id", "left").select(
        "user_id", F.coalesce("n", F.lit(0)).alias("conversions"), F.coalesce("top", F.lit(999)).alias("top")
    )


@star_query("sc_7", "SELECT plan, CAST(count(*) AS VARCHAR) AS rows FROM dim_users GROUP BY 1")
def sc_7(star: Star) -> DataFrame:
    return count_by(star.dim_users, ["plan"], "n").select("plan", F.col("n").cast("string").alias("rows"))


@query(
    "sc_8",
    f"""WITH {DOCS_SQL}, {QV_SQL}
    SELECT id, round({cosine_sql("embedding", "q")}, 6) AS similarity, round(1 - {cosine_sql("embedding", "q")}, 6) AS distance
    FROM docs, qv""",
)
def sc_8(spark, directory):
    target = vectors.vector_literal(query_vector(spark, directory))
    docs = documents_with_vectors(spark, directory)
    return docs.select(
        "id",
        F.round(vectors.cosine_similarity("embedding", target), 6).alias("similarity"),
        F.round(vectors.cosine_distance("embedding", target), 6).alias("distance"),
    )


@query(
    "sc_9",
    f"""WITH {DOCS_SQL}, {text_list_sql(15)} SELECT id, round(0.5 / (60 + text_rank) + 0.5 / (60 + 999), 8) AS score FROM t""",
)
def sc_9(spark, directory):
    words = keyword_candidates(documents_with_vectors(spark, directory), QUERY_WORDS, 15)
    return words.select("id", F.round(fused_score(F.lit(999), F.col("text_rank")), 8).alias("score"))


@query(
    "sc_10",
    f"""SELECT event_id, {stamp("ts")} AS fine, {stamp("date_trunc('second', ts)")} AS coarse,
    CAST(NULL AS VARCHAR) AS broken FROM events""",
)
def sc_10(spark, directory):
    written = raw(spark, directory, "events").select(
        "event_id",
        F.col("ts").cast("string").alias("with_fraction"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("without"),
        F.concat(F.lit("at "), F.col("ts").cast("string")).alias("malformed"),
    )
    return written.select(
        "event_id",
        times.parse_wall_clock("with_fraction").alias("fine"),
        times.parse_wall_clock("without").alias("coarse"),
        times.parse_wall_clock("malformed").alias("broken"),
    )


@query(
    "sc_11",
    """SELECT vec_id, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total FROM embeddings""",
)
def sc_11(spark, directory):
    written = raw(spark, directory, "embeddings").select("vec_id", F.to_json("embedding").alias("literal"))
    parsed = written.select("vec_id", vectors.parse_vector("literal").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return parsed.select("vec_id", F.size("v").cast("bigint").alias("dims"), F.round(total, 5).alias("total"))


@star_query(
    "sc_12",
    """SELECT event_id, CAST(json_extract_string(properties, '$.k') AS BIGINT) AS k,
    CAST(NULL AS VARCHAR) AS absent FROM fact_events""",
)
def sc_12(star: Star) -> DataFrame:
    return star.fact_events.select(
        "event_id",
        values.variant_field("properties", "$.k", "bigint").alias("k"),
        values.json_field("properties", "$.absent").alias("absent"),
    )


# -- joins ------------------------------------------------------------------------------------------------


@star_query(
    "jn_1",
    """SELECT feature_name, count(*) AS uses FROM fact_events e JOIN dim_features f ON e.feature_id = f.feature_id
    GROUP BY 1""",
)
def jn_1(star: Star) -> DataFrame:
    facts = tally(star.fact_events, ["feature_id"])
    return facts.join(star.dim_features, "feature_id").groupBy("feature_name").agg(F.sum("n").alias("uses"))


@star_query(
    "jn_2",
    """SELECT plan, category, channel, count(*) AS events FROM fact_events e JOIN dim_users u ON e.user_id = u.user_id
    JOIN dim_features f ON e.feature_id = f.feature_id JOIN dim_campaigns c ON e.campaign_id = c.campaign_id
    GROUP BY 1, 2, 3""",
)
def jn_2(star: Star) -> DataFrame:
    return _three_way(star, "inner")


def _three_way(star: Star, how: str) -> DataFrame:
    facts = tally(star.fact_events, ["user_id", "feature_id", "campaign_id"])
    return (
        facts.join(star.dim_users.select("user_id", "plan"), "user_id", how)
        .join(star.dim_features.select("feature_id", "category"), "feature_id", how)
        .join(star.dim_campaigns.select("campaign_id", "channel"), "campaign_id", how)
        .groupBy("plan", "category", "channel")
        .agg(F.sum("n").alias("events"))
    )


@query(
    "jn_3",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS orders
    FROM orders JOIN events ON o_custkey = user_id GROUP BY 1""",
)
def jn_3(spark, directory):
    # A join that only filters still multiplies rows when the other side repeats a key.
    orders = raw(spark, directory, "orders").select(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day"))
    seen = tally(raw(spark, directory, "events"), ["user_id"])
    joined = tally(orders, ["day", "user_id"]).join(seen.withColumnRenamed("n", "repeats"), "user_id")
    return joined.groupBy("day").agg(F.sum(F.col("n") * F.col("repeats")).alias("orders"))


@query(
    "jn_4",
    """SELECT c_custkey, c_mktsegment, coalesce(n, 0) AS events FROM customer
    LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) ON user_id = c_custkey""",
)
def jn_4(spark, directory):
    seen = tally(raw(spark, directory, "events"), ["user_id"])
    customers = raw(spark, directory, "customer")
    return customers.join(seen, F.col("c_custkey") == F.col("user_id"), "left").select(
        "c_custkey", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("events")
    )


@query(
    "jn_5",
    f"""WITH {DOCS_SQL}, {QV_SQL}, {vector_list_sql(15)}, {text_list_sql(15)}
    SELECT coalesce(v.id, t.id) AS id, coalesce(vector_rank, 999) AS vector_rank, coalesce(text_rank, 999) AS text_rank
    FROM v FULL JOIN t ON v.id = t.id""",
)
def jn_5(spark, directory):
    docs = documents_with_vectors(spark, directory)
    near = nearest(docs, query_vector(spark, directory), 15)
    words = keyword_candidates(docs, QUERY_WORDS, 15)
    rank = lambda c: F.coalesce(c, F.lit(999)).cast("bigint").alias(c)
    return near.join(words, "id", "full").select("id", rank("vector_rank"), rank("text_rank"))


@query("jn_6", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def jn_6(spark, directory):
    buyers = raw(spark, directory, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey")).distinct()
    return raw(spark, directory, "customer").join(buyers, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("jn_7", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)")
def jn_7(spark, directory):
    seen = raw(spark, directory, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    return raw(spark, directory, "customer").join(seen, "c_custkey", "left_anti").select("c_custkey", "c_name")


@star_query(
    "jn_8",
    """SELECT (SELECT count(*) FROM fact_events) AS events, (SELECT count(*) FROM fact_conversions) AS conversions,
    (SELECT count(*) FROM dim_users) AS users""",
)
def jn_8(star: Star) -> DataFrame:
    one = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return star.dim_users.agg(F.count(F.lit(1)).alias("users")).select(
        one(star.fact_events).alias("events"), one(star.fact_conversions).alias("conversions"), "users"
    )


# -- aggregates -------------------------------------------------------------------------------------------


@star_query(
    "ag_1",
    """SELECT event_type, count(*) AS events FROM fact_events GROUP BY 1
    UNION ALL SELECT 'all', count(*) FROM fact_events""",
)
def ag_1(star: Star) -> DataFrame:
    by_type = count_by(star.fact_events, ["event_type"], "events")
    return by_type.unionByName(by_type.agg(F.sum("events").alias("events")).withColumn("event_type", F.lit("all")))


@star_query("ag_2", "SELECT event_type, count(DISTINCT user_id) AS users FROM fact_events GROUP BY 1")
def ag_2(star: Star) -> DataFrame:
    return star.fact_events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@star_query(
    "ag_3",
    """SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users, count(DISTINCT feature_id) AS features,
    count(DISTINCT session_id) AS sessions FROM fact_events GROUP BY 1""",
)
def ag_3(star: Star) -> DataFrame:
    return star.fact_events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("feature_id").alias("features"),
        F.count_distinct("session_id").alias("sessions"),
    )


@star_query(
    "ag_4",
    """SELECT conversion_type, CAST(sum(revenue) AS DOUBLE) AS total, CAST(round(sum(revenue), 2) AS DOUBLE) AS rounded,
    round(CAST(sum(revenue) AS DOUBLE) / count(revenue), 6) AS average, CAST(max(revenue) AS DOUBLE) AS largest
    FROM fact_conversions GROUP BY 1""",
)
def ag_4(star: Star) -> DataFrame:
    total = F.sum("revenue").cast("double")
    return star.fact_conversions.groupBy("conversion_type").agg(
        total.alias("total"),
        values.rounded_sum("revenue", 2).alias("rounded"),
        F.round(total / F.count("revenue"), 6).alias("average"),
        F.max("revenue").alias("largest"),
    )


@star_query(
    "ag_5",
    """SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS day, strftime(event_time, '%Y-%m-%d %H:00:00') AS hour,
    count(*) AS events FROM fact_events GROUP BY 1, 2""",
)
def ag_5(star: Star) -> DataFrame:
    return count_by(
        star.fact_events, [F.to_date("event_time").alias("day"), times.hour_label("event_time").alias("hour")], "events"
    )


@query(
    "ag_6",
    """SELECT l_returnflag, l_linestatus, l_linenumber, year(l_shipdate) AS y, month(l_shipdate) AS m,
    CAST(l_quantity AS BIGINT) AS q, l_discount, l_tax, count(*) AS lines FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
)
def ag_6(spark, directory):
    raw(spark, directory, "lineitem").createOrReplaceTempView("tidemark_lines")
    return spark.sql(
        """SELECT l_returnflag, l_linestatus, l_linenumber, CAST(year(l_shipdate) AS BIGINT) AS y,
        CAST(month(l_shipdate) AS BIGINT) AS m, CAST(l_quantity AS BIGINT) AS q, l_discount, l_tax, count(*) AS lines
        FROM tidemark_lines GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""
    )


_SOLD = """FROM fact_conversions JOIN dim_campaigns USING (campaign_id) JOIN dim_features USING (feature_id), clock
  WHERE conversion_time >= as_of - INTERVAL 30 DAYS"""


@star_query(
    "ag_7",
    f"SELECT feature_name, count(*) AS total {_SOLD} GROUP BY feature_name QUALIFY row_number() OVER (ORDER BY count(*) DESC, feature_name) <= 5",
)
def ag_7(star: Star) -> DataFrame:
    totals = conversion_counts(star).groupBy("feature_name").agg(F.sum("conversions").alias("total"))
    return top_k(totals, 5, F.desc("total"), F.asc("feature_name"))


@star_query(
    "ag_8",
    """SELECT 'fact_events' AS tbl, coalesce(max(event_id), 0) AS top FROM fact_events
    UNION ALL SELECT 'dim_users', coalesce(max(user_id), 0) FROM dim_users
    UNION ALL SELECT 'no_rows', coalesce(max(user_id), 0) FROM dim_users WHERE user_id < 0""",
)
def ag_8(star: Star) -> DataFrame:
    sources = {
        "fact_events": (star.fact_events, "event_id"),
        "dim_users": (star.dim_users, "user_id"),
        "no_rows": (star.dim_users.where("user_id < 0"), "user_id"),
    }
    one = star.dim_users.sparkSession.range(1)
    return stacked(
        [one.select(F.lit(name).alias("tbl"), high_water_mark(df, key).alias("top")) for name, (df, key) in sources.items()]
    )


# -- ranks and sorts --------------------------------------------------------------------------------------


@query(
    "wn_1",
    f"WITH {DOCS_SQL}, {QV_SQL}, {vector_list_sql(15)} SELECT id, vector_rank AS rank FROM v",
)
def wn_1(spark, directory):
    return nearest(documents_with_vectors(spark, directory), query_vector(spark, directory), 15).select(
        "id", F.col("vector_rank").alias("rank")
    )


@query(
    "wn_2",
    f"""WITH {TEXTS_SQL} SELECT id, row_number() OVER (ORDER BY id) AS rank FROM texts
    WHERE {any_term_sql("content", QUERY_WORDS)} ORDER BY id LIMIT 15""",
)
def wn_2(spark, directory):
    matches = texts_only(spark, directory).where(texts.match_any("content", QUERY_WORDS)).select("id")
    return ranked_head(matches, 15, [F.asc("id")], "rank").withColumn("rank", F.col("rank").cast("bigint"))


def _numbered(df: DataFrame, *order) -> DataFrame:
    """A sorted result with its position, so that a check of unordered rows also checks the order."""
    return assign_ids(df, 0, list(order), "position")


@star_query(
    "so_1",
    """SELECT event_type, n AS events, row_number() OVER (ORDER BY n DESC, event_type) AS position
    FROM (SELECT event_type, count(*) AS n FROM fact_events GROUP BY 1)""",
)
def so_1(star: Star) -> DataFrame:
    return _numbered(count_by(star.fact_events, ["event_type"], "events"), F.desc("events"), F.asc("event_type"))


@star_query(
    "so_2",
    """SELECT plan, country, n AS users, row_number() OVER (ORDER BY plan ASC NULLS LAST, n DESC, country) AS position
    FROM (SELECT plan, country, count(*) AS n FROM dim_users GROUP BY 1, 2)""",
)
def so_2(star: Star) -> DataFrame:
    counted = count_by(star.dim_users, ["plan", "country"], "users")
    return _numbered(counted, F.asc_nulls_last("plan"), F.desc("users"), F.asc("country"))


@star_query(
    "so_3",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT {k} AS k, user_id, count(*) AS events FROM fact_events GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT {k})"
        for k in (5, 10, 30, 50)
    ),
)
def so_3(star: Star) -> DataFrame:
    counted = count_by(star.fact_events, ["user_id"], "events")
    return stacked(
        [
            top_k(counted, k, F.desc("events"), F.asc("user_id")).select(F.lit(k).alias("k"), "user_id", "events")
            for k in (5, 10, 30, 50)
        ]
    )


@star_query(
    "so_4",
    f"""SELECT event_id, {stamp("event_time")} AS event_time FROM fact_events
    ORDER BY fact_events.event_time DESC, event_id DESC LIMIT 100""",
)
def so_4(star: Star) -> DataFrame:
    return top_k(star.fact_events.select("event_id", "event_time"), 100, F.desc("event_time"), F.desc("event_id"))


@star_query("so_5", "SELECT user_id, email FROM dim_users ORDER BY user_id LIMIT 5")
def so_5(star: Star) -> DataFrame:
    return top_k(star.dim_users.select("user_id", "email"), 5, F.asc("user_id"))


# -- set operations and shared subqueries -----------------------------------------------------------------


@star_query(
    "st_u",
    """SELECT 'event' AS kind, event_type AS name, count(*) AS rows FROM fact_events GROUP BY 2
    UNION ALL SELECT 'conversion', conversion_type, count(*) FROM fact_conversions GROUP BY 2""",
)
def st_u(star: Star) -> DataFrame:
    events = count_by(star.fact_events, [F.lit("event").alias("kind"), F.col("event_type").alias("name")], "rows")
    return events.unionByName(
        count_by(star.fact_conversions, [F.lit("conversion").alias("kind"), F.col("conversion_type").alias("name")], "rows")
    )


@star_query(
    "ct_1",
    f"""SELECT channel, feature_name, conversion_type, conversions FROM (
      SELECT *, dense_rank() OVER (ORDER BY total DESC, feature_name) AS place FROM (
        SELECT channel, feature_name, conversion_type, count(*) AS conversions, sum(count(*)) OVER (PARTITION BY feature_name) AS total
        {_SOLD} GROUP BY channel, feature_name, conversion_type)) WHERE place <= 5""",
)
def ct_1(star: Star) -> DataFrame:
    counts = conversion_counts(star)
    totals = counts.groupBy("feature_name").agg(F.sum("conversions").alias("total"))
    top = top_k(totals, 5, F.desc("total"), F.asc("feature_name")).select("feature_name")
    return counts.join(top, "feature_name", "left_semi")
