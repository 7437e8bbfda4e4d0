"""Registration of queries, with the checking SQL beside each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The star over the given tables, as SQL; the DataFrame form is sources.star.star_from_shop.
STAR = """WITH dim_users AS (
  SELECT c.c_custkey AS user_id, 'user' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email, c.c_name AS name,
         c.c_mktsegment AS plan, n.n_name AS country
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
dim_features AS (
  SELECT p_partkey AS feature_id, p_name AS feature_name, p_type AS category, p_brand AS tier_required FROM part),
dim_campaigns AS (
  SELECT CAST(n_nationkey AS BIGINT) AS campaign_id, n_name AS campaign_name, r_name AS channel, n_name AS source,
         lower(r_name) AS medium
  FROM nation JOIN region ON n_regionkey = r_regionkey),
fact_events AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS feature_id,
         event_id % 25 AS campaign_id,
         'sess_' || CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         CASE event_type WHEN 'click' THEN 'feature_use' WHEN 'view' THEN 'page_view' ELSE event_type END AS event_type,
         ts AS event_time, props AS properties
  FROM events),
fact_conversions AS (
  SELECT event_id AS conversion_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS feature_id,
         event_id % 25 AS campaign_id, event_type AS conversion_type, ts AS conversion_time,
         CAST(value AS DECIMAL(10,2)) AS revenue
  FROM events WHERE event_type IN ('signup', 'purchase')),
clock AS (SELECT max(ts) AS as_of FROM events)
"""

# SQL pieces used in many checks.
NOW = "(SELECT as_of FROM clock)"
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def stamp(column: str) -> str:
    return STAMP.format(column)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, directory)``; ``sql`` must give the same rows and column names."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, directory: portable(fn(spark, directory))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def portable(df: DataFrame) -> DataFrame:
    """Days and times as text and decimals as double, so that two engines print them alike."""
    shown = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DateType):
            shown[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DecimalType):
            shown[field.name] = F.col(field.name).cast("double")
    return df.withColumns(shown) if shown else df
