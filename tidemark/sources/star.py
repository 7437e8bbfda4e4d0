"""The five star tables: loading, naming, and the view of order data as a star."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.values import MONEY, json_field
from .schemas import SHOP_SCHEMAS, STAR_SCHEMAS, conform


class Star:
    """Three dimensions and two facts. A table given as a function is opened when it is first used."""

    NAMES = ("dim_users", "dim_features", "dim_campaigns", "fact_events", "fact_conversions")

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        missing = set(self.NAMES) - set(tables)
        if missing:
            raise ValueError(f"missing tables: {sorted(missing)}")
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name not in Star.NAMES:
            raise AttributeError(name)
        table = self._tables[name]
        if callable(table):
            table = self._tables[name] = table()
        return table

    def replace(self, **tables: DataFrame) -> "Star":
        return Star(**{**self._tables, **tables})

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.NAMES}

    def register_views(self) -> "Star":
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)
        return self


def load_star(spark: SparkSession, directory: str, views: bool = True) -> Star:
    """Read the five tables stored under their own names."""
    def opened(name: str) -> DataFrame:
        return conform(spark.read.parquet(f"{directory}/{name}.parquet"), name)

    star = Star(**{name: partial(opened, name) for name in STAR_SCHEMAS})
    return star.register_views() if views else star


def raw(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """One of the given tables; a declared schema saves the job that would infer it."""
    reader = spark.read
    if table in SHOP_SCHEMAS:
        reader = reader.schema(SHOP_SCHEMAS[table])
    return reader.parquet(f"{directory}/{table}.parquet")


def star_from_shop(spark: SparkSession, directory: str) -> Star:
    """A star over customers, parts, nations and the event stream.

    Every column is an expression over the scan, so a query that does not use one never reads it.
    """
    return Star(
        dim_users=lambda: _users(spark, directory),
        dim_features=lambda: _features(spark, directory),
        dim_campaigns=lambda: _campaigns(spark, directory),
        fact_events=lambda: _shop_events(spark, directory),
        fact_conversions=lambda: _shop_conversions(spark, directory),
    )


def star_from_orders(spark: SparkSession, directory: str) -> Star:
    """The same star with order lines as facts: one use and one conversion per line."""
    return star_from_shop(spark, directory).replace(
        fact_events=lambda: _order_events(spark, directory),
        fact_conversions=lambda: _order_conversions(spark, directory),
    )


def _users(spark: SparkSession, directory: str) -> DataFrame:
    customer, nation = raw(spark, directory, "customer"), raw(spark, directory, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("plan"),
        F.col("n_name").alias("country"),
    )


def _features(spark: SparkSession, directory: str) -> DataFrame:
    return raw(spark, directory, "part").select(
        F.col("p_partkey").alias("feature_id"),
        F.col("p_name").alias("feature_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("tier_required"),
    )


def _campaigns(spark: SparkSession, directory: str) -> DataFrame:
    nation, region = raw(spark, directory, "nation"), raw(spark, directory, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("campaign_id"),
        F.col("n_name").alias("campaign_name"),
        F.col("r_name").alias("channel"),
        F.col("n_name").alias("source"),
        F.lower("r_name").alias("medium"),
    )


def _shop_events(spark: SparkSession, directory: str) -> DataFrame:
    return raw(spark, directory, "events").select(
        "event_id",
        "user_id",
        json_field("props", "$.k", "bigint").alias("feature_id"),
        (F.col("event_id") % 25).alias("campaign_id"),
        F.concat(
            F.lit("sess_"), F.col("user_id").cast("string"), F.lit("_"), F.to_date("ts").cast("string")
        ).alias("session_id"),
        F.when(F.col("event_type") == "click", "feature_use")
        .when(F.col("event_type") == "view", "page_view")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.col("ts").alias("event_time"),
        F.col("props").alias("properties"),
    )


def _shop_conversions(spark: SparkSession, directory: str) -> DataFrame:
    converting = raw(spark, directory, "events").where(F.col("event_type").isin("signup", "purchase"))
    return converting.select(
        F.col("event_id").alias("conversion_id"),
        "user_id",
        json_field("props", "$.k", "bigint").alias("feature_id"),
        (F.col("event_id") % 25).alias("campaign_id"),
        F.col("event_type").alias("conversion_type"),
        F.col("ts").alias("conversion_time"),
        F.col("value").cast(MONEY).alias("revenue"),
    )


def _order_lines(spark: SparkSession, directory: str) -> DataFrame:
    lines, orders = raw(spark, directory, "lineitem"), raw(spark, directory, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns(
        {
            "line_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "user_id": F.col("o_custkey"),
            "feature_id": F.col("l_partkey"),
            "campaign_id": F.col("l_suppkey") % 25,
        }
    )


def _order_events(spark: SparkSession, directory: str) -> DataFrame:
    return _order_lines(spark, directory).select(
        F.col("line_id").alias("event_id"),
        "user_id",
        "feature_id",
        "campaign_id",
        F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("session_id"),
        F.when(F.col("l_returnflag") == "R", "page_view").otherwise("feature_use").alias("event_type"),
        F.col("o_orderdate").alias("event_time"),
    )


def _order_conversions(spark: SparkSession, directory: str) -> DataFrame:
    return _order_lines(spark, directory).select(
        F.col("line_id").alias("conversion_id"),
        "user_id",
        "feature_id",
        "campaign_id",
        F.col("o_orderpriority").alias("conversion_type"),
        F.col("o_orderdate").alias("conversion_time"),
        F.col("l_extendedprice").cast(MONEY).alias("revenue"),
    )
