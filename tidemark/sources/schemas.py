"""Fixed schemas of the star tables, messages and telemetry documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

STAR_SCHEMAS = {
    "dim_users": (
        "user_id bigint, email string, name string, signup_date date, plan string, "
        "country string, industry string, properties string"
    ),
    "dim_features": (
        "feature_id bigint, feature_name string, category string, description string, tier_required string"
    ),
    "dim_campaigns": (
        "campaign_id bigint, campaign_name string, channel string, source string, medium string, properties string"
    ),
    "fact_events": (
        "event_id bigint, user_id bigint, feature_id bigint, campaign_id bigint, session_id string, "
        "event_type string, event_time timestamp_ntz, page_url string, search_query string, properties string"
    ),
    "fact_conversions": (
        "conversion_id bigint, user_id bigint, feature_id bigint, campaign_id bigint, conversion_type string, "
        "conversion_time timestamp_ntz, plan_from string, plan_to string, revenue decimal(10,2), properties string"
    ),
}

# Order, event and document tables that stand in for the star.
SHOP_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
}

# Unique keys of the star tables.
STAR_KEYS = {
    "dim_users": ["user_id"],
    "dim_features": ["feature_id"],
    "dim_campaigns": ["campaign_id"],
    "fact_events": ["event_id"],
    "fact_conversions": ["conversion_id"],
}

# JSON messages carry their times as text; the parser accepts them with and without a fraction.
EVENT_MESSAGE = STAR_SCHEMAS["fact_events"].replace("timestamp_ntz", "string")
CONVERSION_MESSAGE = STAR_SCHEMAS["fact_conversions"].replace("timestamp_ntz", "string")

PRODUCT_DOCUMENT = (
    "id string, name string, description string, picture string, "
    "priceUsd struct<currencyCode:string,units:bigint,nanos:bigint>, categories array<string>"
)


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(STAR_SCHEMAS[table])


#: Column of the day folders that dated tables have beside their own columns.
DAY = "event_date"


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast to the declared columns; one the input lacks becomes null, unless it is a key. A day column stays."""
    present = set(df.columns)
    missing = [key for key in STAR_KEYS[table] if key not in present]
    if missing:
        raise ValueError(f"{table} lacks its key columns {missing}")
    columns = [F.col(DAY)] if DAY in present else []
    for field in schema_of(table).fields:
        source = F.col(field.name) if field.name in present else F.lit(None)
        columns.append(source.cast(field.dataType).alias(field.name))
    return df.select(*columns)
