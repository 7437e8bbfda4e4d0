"""Sources, change application, sinks, telemetry and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import in_zone, whole_seconds
from ..functions.values import MONEY
from ..functions.vectors import parse_vector
from ..operators import changes as ch, quality as q, telemetry as t
from ..operators.activity import count_by, high_water_mark
from ..operators.filters import Clock, retain
from ..operators.ids import assign_ids
from ..operators.retrieval import bucket_counts, chunked, hashed_vector, unit_vector
from ..plans import analytics as a
from ..session import work_path
from ..sources import writers as w
from ..sources.readers import parse_messages, read_snapshot, spread
from ..sources.schemas import PRODUCT_DOCUMENT, STAR_KEYS, conform
from ..sources.star import Star, load_star, raw, star_from_shop
from .base import NOW, STAR, query, stamp
from .expressions import star_query
from .retrieval import all_texts, tokens_sql

# -- the event stream as a change log ---------------------------------------------------------------------

ROW = "user_id bigint, amount double, position bigint, kind string"


def envelopes(spark: SparkSession, directory: str) -> DataFrame:
    """Events as change envelopes keyed by user: an error deletes the user's row, anything else writes it."""
    events = spread(raw(spark, directory, "events"))
    position = F.col("event_id") + 1
    row = F.struct("user_id", F.col("value").alias("amount"), position.alias("position"), F.col("event_type").alias("kind"))
    gone = F.col("event_type") == "error"
    return ch.encode_changes(
        events, F.when(gone, "d").otherwise("u"), position, F.when(gone, row), F.when(~gone, row)
    )


def user_changes(spark: SparkSession, directory: str) -> DataFrame:
    return ch.decode_changes(envelopes(spark, directory), "value", ROW, ["user_id"])


def user_base(spark: SparkSession, directory: str) -> DataFrame:
    return raw(spark, directory, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").alias("amount"),
        F.lit(0).cast("bigint").alias("position"),
        F.lit("snapshot").alias("kind"),
    )


CHANGES_SQL = """WITH changes AS (SELECT user_id, value AS amount, event_id + 1 AS position, event_type AS kind,
  event_id + 1 AS seq, CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op FROM events),
base AS (SELECT c_custkey AS user_id, c_acctbal AS amount, 0 AS position, 'snapshot' AS kind FROM customer)"""


def applied_sql(condition: str = "TRUE") -> str:
    return f"""SELECT user_id, amount, position, kind FROM base
    WHERE user_id NOT IN (SELECT user_id FROM changes WHERE {condition})
    UNION ALL SELECT user_id, amount, position, kind FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS r
      FROM changes WHERE {condition}) WHERE r = 1 AND op <> 'd'"""


# -- sources ----------------------------------------------------------------------------------------------


@star_query(
    "src_1",
    " UNION ALL ".join(
        f"SELECT '{name}' AS tbl, count(*) AS cnt, CAST(sum({keys[0]}) AS BIGINT) AS key_sum FROM {name}"
        for name, keys in STAR_KEYS.items()
    ),
)
def src_1(star: Star) -> DataFrame:
    spark = star.dim_users.sparkSession
    root = work_path(spark, "star")
    for name, df in star.tables().items():
        conform(df, name).write.parquet(f"{root}/{name}.parquet")
    load_star(spark, root)
    return q.stacked(
        [
            spark.table(name).agg(F.count(F.lit(1)).alias("cnt"), F.sum(keys[0]).alias("key_sum")).select(
                F.lit(name).alias("tbl"), "cnt", "key_sum"
            )
            for name, keys in STAR_KEYS.items()
        ]
    )


@query(
    "src_2",
    f"""SELECT o_orderkey AS order_id, o_custkey AS user_id, {stamp("o_orderdate")} AS ordered_at,
    CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS total FROM orders""",
)
def src_2(spark, directory):
    columns = {
        "order_id": "o_orderkey",
        "user_id": "o_custkey",
        "ordered_at": "o_orderdate",
        "total": F.col("o_totalprice").cast(MONEY),
    }
    return read_snapshot(spark, f"{directory}/orders.parquet", columns)


@query(
    "src_4",
    """SELECT doc_id AS id, length(text) AS chars, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total
    FROM documents LEFT JOIN embeddings ON doc_id = vec_id""",
)
def src_4(spark, directory):
    texts = raw(spark, directory, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    literals = raw(spark, directory, "embeddings").select(F.col("vec_id").alias("id"), F.to_json("embedding").alias("literal"))
    docs = texts.join(literals.select("id", parse_vector("literal").alias("embedding")), "id", "left")
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return docs.select(
        "id",
        F.length("content").cast("bigint").alias("chars"),
        F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("bigint").alias("dims"),
        F.round(total, 5).alias("total"),
    )


# -- changes ----------------------------------------------------------------------------------------------


@query("ing_1", f"{CHANGES_SQL} SELECT op, seq, user_id, amount, kind FROM changes")
def ing_1(spark, directory):
    return user_changes(spark, directory).select("op", "seq", "user_id", "amount", "kind")


@query(
    "ing_2",
    f"""{CHANGES_SQL} SELECT 'r' AS op, 0 AS seq, user_id, amount FROM base
    UNION ALL SELECT op, seq, user_id, amount FROM changes""",
)
def ing_2(spark, directory):
    log = ch.snapshot_then_changes(user_base(spark, directory), user_changes(spark, directory).drop("before"))
    return log.select("op", "seq", "user_id", "amount")


@query(
    "ing_3",
    f"""{CHANGES_SQL} SELECT CASE WHEN amount < 10 THEN 'small' ELSE 'large' END AS size, count(*) AS deletes,
    round(sum(amount), 2) AS amount FROM changes WHERE op = 'd' GROUP BY 1""",
)
def ing_3(spark, directory):
    deletes = user_changes(spark, directory).where("op = 'd'")
    size = F.when(F.col("before.amount") < 10, "small").otherwise("large")
    return deletes.groupBy(size.alias("size")).agg(
        F.count(F.lit(1)).alias("deletes"), F.round(F.sum("before.amount"), 2).alias("amount")
    )


@query(
    "ing_4",
    f"""SELECT c_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS nation_id, e.event_id,
    {stamp("date_trunc('second', ts)")} AS event_time, json_extract_string(props, '$.k') AS k
    FROM events e JOIN customer ON user_id = c_custkey""",
)
def ing_4(spark, directory):
    users = raw(spark, directory, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("nation_id")
    )
    events = raw(spark, directory, "events").select(
        "event_id",
        "user_id",
        whole_seconds("ts").alias("event_time"),
        F.to_json(F.from_json("props", "struct<k:bigint>")).alias("properties"),
    )
    return events.join(users, "user_id").select(
        "user_id", "nation_id", "event_id", "event_time", F.get_json_object("properties", "$.k").alias("k")
    )


@query("ing_5", CHANGES_SQL + applied_sql("op <> 'd'"))
def ing_5(spark, directory):
    upserts = user_changes(spark, directory).where("op <> 'd'")
    return ch.apply_upserts(user_base(spark, directory), upserts, ["user_id"])


@query("ing_6", CHANGES_SQL + applied_sql())
def ing_6(spark, directory):
    return ch.apply_upserts(user_base(spark, directory), user_changes(spark, directory), ["user_id"])


@query(
    "ing_7",
    """WITH last AS (SELECT user_id, event_type FROM (SELECT user_id, event_type,
      row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1)
    SELECT c_custkey AS user_id, c_name AS name, coalesce(event_type, c_mktsegment) AS plan
    FROM customer LEFT JOIN last ON user_id = c_custkey""",
)
def ing_7(spark, directory):
    # Every event sets its user's plan; the other column of the row is sent along unchanged.
    users = raw(spark, directory, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("plan")
    )
    updates = (
        raw(spark, directory, "events")
        .join(users.drop("plan"), "user_id")
        .select(
            F.lit("u").alias("op"), (F.col("event_id") + 1).alias("seq"), "user_id", "name", F.col("event_type").alias("plan")
        )
    )
    return ch.apply_upserts(users, updates, ["user_id"])


@query("ing_8", "SELECT event_type, 2 * count(*) AS rows FROM events GROUP BY 1")
def ing_8(spark, directory):
    path = work_path(spark, "append")
    events = raw(spark, directory, "events")
    w.append(events, path)
    w.append(events, path, records_per_file=1000)
    return count_by(spark.read.parquet(path), ["event_type"], "rows")


@query(
    "ing_10",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1""",
)
def ing_10(spark, directory):
    log = raw(spark, directory, "events").select("user_id", "event_id", "event_type", "value")
    return ch.read_latest(log, ["user_id"], F.desc("event_id"))


ROUTES = {kind: f"events_{kind}" for kind in ("click", "error", "purchase", "signup", "view")}


@query("ing_11", "SELECT 'events_' || event_type AS target_table, count(*) AS rows FROM events GROUP BY 1")
def ing_11(spark, directory):
    return count_by(ch.routed(raw(spark, directory, "events"), "event_type", ROUTES), ["target_table"], "rows")


@query(
    "ing_12",
    """SELECT CASE WHEN event_type = 'error' THEN 'missing' ELSE 'same' END AS status, count(*) AS keys,
    count(*) AS source_rows, count(*) FILTER (event_type <> 'error') AS target_rows FROM events GROUP BY 1""",
)
def ing_12(spark, directory):
    # Path one stores the table, path two receives messages (without errors, each delivered twice) and dedupes at read.
    stored = raw(spark, directory, "events").select("event_id", "user_id", "event_type", F.col("ts").alias("event_time"))
    written = stored.withColumn("event_time", F.col("event_time").cast("string"))
    sent = written.where("event_type <> 'error'").select(F.to_json(F.struct("*")).alias("value"))
    schema = "event_id bigint, user_id bigint, event_type string, event_time string"
    received = parse_messages(sent.unionByName(sent), "value", schema, ["event_time"])
    deduped = ch.read_latest(received, ["event_id"], F.desc("event_time"))
    return q.reconcile_summary(stored, deduped.select(*stored.columns), ["event_id"])


@query(
    "ing_13",
    """SELECT event_id, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY ts, event_id) AS id FROM events""",
)
def ing_13(spark, directory):
    top = high_water_mark(raw(spark, directory, "orders"), "o_orderkey")
    events = raw(spark, directory, "events").select("ts", "event_id")
    return assign_ids(events, top, ["ts", "event_id"], "id").select("event_id", "id")


@query(
    "ing_14",
    """SELECT c_custkey AS user_id, CASE WHEN c_acctbal < 0 THEN 'Free' WHEN c_mktsegment = 'BUILDING' THEN NULL
    ELSE c_mktsegment END AS plan FROM customer""",
)
def ing_14(spark, directory):
    # Overdrawn customers are sent without a plan, those of one segment with an explicit null.
    customers = raw(spark, directory, "customer").withColumn(
        "segment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    )
    sent = customers.select(
        F.when(F.col("c_acctbal") < 0, F.to_json(F.struct(F.col("c_custkey").alias("user_id"))))
        .otherwise(
            F.to_json(F.struct(F.col("c_custkey").alias("user_id"), F.col("segment").alias("plan")), {"ignoreNullFields": "false"})
        )
        .alias("value")
    )
    return ch.with_defaults(sent, "value", "user_id bigint, plan string", {"plan": "Free"})


@query(
    "ing_15",
    """SELECT c_custkey AS user_id, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'old' ELSE 'new' END AS origin
    FROM customer""",
)
def ing_15(spark, directory):
    # Customers with orders are there already; all customers arrive, each twice.
    known = raw(spark, directory, "orders").select(F.col("o_custkey").alias("user_id")).distinct()
    base = known.withColumn("origin", F.lit("old"))
    arriving = raw(spark, directory, "customer").select(F.col("c_custkey").alias("user_id"), F.lit("new").alias("origin"))
    return ch.insert_ignore(base, arriving.unionByName(arriving), ["user_id"], F.asc("origin"))


@query("ing_16", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def ing_16(spark, directory):
    nation = raw(spark, directory, "nation")
    path = work_path(spark, "table")
    name = "tidemark_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        w.ensure_table(spark, name, nation.schema, path)
        w.seed_if_empty(spark, name, nation)
    return spark.table(name)


@query(
    "ing_20",
    f"""{STAR} SELECT 'event_types' AS tbl, count(DISTINCT event_type) AS cnt FROM fact_events
    UNION ALL SELECT 'revenue_by_type', count(DISTINCT conversion_type) FROM fact_conversions
    UNION ALL SELECT 'daily_activity', count(DISTINCT CAST(event_time AS DATE)) FROM fact_events
      WHERE event_time >= {NOW} - INTERVAL 30 DAYS
    UNION ALL SELECT 'activity_per_plan', count(DISTINCT plan) FROM dim_users JOIN fact_events USING (user_id)
      WHERE event_time >= {NOW} - INTERVAL 7 DAYS""",
)
def ing_20(spark, directory):
    star = star_from_shop(spark, directory)
    names = ("event_types", "revenue_by_type", "daily_activity", "activity_per_plan")
    paths = w.materialize({n: a.NAMED[n](star) for n in names}, work_path(spark, "materialized"))
    return q.table_counts({n: spark.read.parquet(p) for n, p in paths.items()})


@query(
    "ing_22",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, 'USD' AS currency, round(p_retailprice, 2) AS price, c AS category
    FROM (SELECT *, unnest([p_type, p_brand]) AS c FROM part)""",
)
def ing_22(spark, directory):
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    units = F.floor(cents / 100)
    document = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.struct(
            F.lit("USD").alias("currencyCode"),
            units.alias("units"),
            ((cents - units * 100) * 10_000_000).alias("nanos"),
        ).alias("priceUsd"),
        F.array("p_type", "p_brand").alias("categories"),
    )
    sent = raw(spark, directory, "part").select(F.to_json(document).alias("document"))
    return t.flatten_products(sent, "document", PRODUCT_DOCUMENT).select("id", "name", "currency", "price", "category")


# -- telemetry --------------------------------------------------------------------------------------------


def log_records(spark: SparkSession, directory: str) -> DataFrame:
    """Events as log records; views carry no service name."""
    name = F.when(F.col("event_type") != "view", F.col("event_type"))
    return raw(spark, directory, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.when(name.isNotNull(), F.create_map(F.lit("service.name"), name)).alias("resource_attributes"),
    )


@query("tel_2", "SELECT event_id FROM events WHERE event_type <> 'error'")
def tel_2(spark, directory):
    return t.drop_resource(log_records(spark, directory), "service.name", "error").select("event_id")


@query(
    "tel_4_dated",
    f"""WITH clock AS (SELECT max(ts) AS as_of FROM events)
    SELECT event_id, {stamp("ts")} AS timestamp FROM events WHERE CAST(ts AS DATE) >= CAST({NOW} AS DATE) - 7""",
)
def tel_4_dated(spark, directory):
    path = work_path(spark, "dated")
    records = log_records(spark, directory).select("event_id", "timestamp")
    w.write_dated(records, path, "timestamp")
    dated = spark.read.parquet(path)
    return retain(dated, "timestamp", 7, Clock.latest(records, "timestamp"), "event_date").select("event_id", "timestamp")


@query(
    "tel_6",
    f"""SELECT event_id, {stamp("timezone('Asia/Tokyo', timezone('UTC', ts))")} AS tokyo,
    {stamp("timezone('America/New_York', timezone('UTC', ts))")} AS new_york FROM events""",
)
def tel_6(spark, directory):
    return raw(spark, directory, "events").select(
        "event_id", in_zone("ts", "Asia/Tokyo").alias("tokyo"), in_zone("ts", "America/New_York").alias("new_york")
    )


@query("tel_7", "SELECT event_id FROM events WHERE event_type NOT IN ('error', 'view')")
def tel_7(spark, directory):
    # Errors are stamped with the epoch, views not at all.
    stamped = raw(spark, directory, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
        .when(F.col("event_type") != "view", F.col("ts"))
        .alias("timestamp"),
    )
    return t.drop_zero_time(stamped).select("event_id")


def access_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Events printed as proxy access-log lines."""
    status = F.when(F.col("event_type") == "error", 500).otherwise(200)
    line = F.format_string(
        '[%s] "%s /feature/%s HTTP/1.1" %d - via_upstream - "-" 0 %d %d - "-" "agent %d" "%d" "shop:8080" '
        '"10.0.0.1:80" frontend 10.0.0.2:1 10.0.0.3:2 10.0.0.4:3 - %s',
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        F.when(F.col("event_type") == "purchase", "POST").otherwise("GET"),
        F.get_json_object("props", "$.k"),
        status,
        F.col("event_id"),
        F.col("user_id"),
        F.col("user_id"),
        F.col("event_id"),
        F.col("event_type"),
    )
    return spread(raw(spark, directory, "events")).select(line.alias("line"))


@query(
    "tel_8",
    """SELECT '/feature/' || json_extract_string(props, '$.k') AS path, event_type AS route_name,
    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS response_code, count(*) AS requests,
    CAST(sum(event_id) AS BIGINT) AS bytes_sent, round(CAST(sum(user_id) AS DOUBLE) / count(*), 6) AS mean_duration_ms
    FROM events GROUP BY 1, 2, 3""",
)
def tel_8(spark, directory):
    parsed = t.parse_access_log(access_lines(spark, directory), "line")
    counted = t.requests_by(parsed, "path", "route_name", "response_code")
    return counted.withColumns(
        {"response_code": F.col("response_code").cast("int"), "mean_duration_ms": F.round("mean_duration_ms", 6)}
    )


# -- data quality -----------------------------------------------------------------------------------------


@star_query(
    "dq_1", " UNION ALL ".join(f"SELECT '{name}' AS tbl, count(*) AS cnt FROM {name}" for name in STAR_KEYS)
)
def dq_1(star: Star) -> DataFrame:
    return q.table_counts(star.tables())


@query(
    "dq_2",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'missing' WHEN o_orderstatus = 'P' THEN 'different' ELSE 'same' END AS status,
    count(*) AS keys, count(*) AS source_rows, count(*) FILTER (o_orderstatus <> 'F') AS target_rows FROM orders GROUP BY 1
    UNION ALL SELECT 'extra', count(*), 0, count(*) FROM customer""",
)
def dq_2(spark, directory):
    # The target lost one status, has another price for a second, and got rows of another table (negative keys).
    source = raw(spark, directory, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    target = source.where("o_orderstatus <> 'F'").withColumn("o_totalprice", price)
    stray = raw(spark, directory, "customer").select(
        (-1 - F.col("c_custkey")).alias("o_orderkey"),
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_acctbal").alias("o_totalprice"),
        F.lit("O").alias("o_orderstatus"),
    )
    return q.reconcile_summary(source, target.unionByName(stray), ["o_orderkey"])


@star_query(
    "dq_3",
    f"""SELECT {stamp("max(conversion_time)")} AS latest, date_sub('second', max(conversion_time), {NOW}) AS lag_seconds
    FROM fact_conversions""",
)
def dq_3(star: Star) -> DataFrame:
    return q.freshness(star.fact_conversions, "conversion_time", a.clock_of(star))


@query(
    "dq_4",
    """SELECT 'not_null:o_orderdate' AS rule, count(*) FILTER (o_orderdate IS NULL) AS violations FROM orders
    UNION ALL SELECT 'max_length:o_orderpriority', count(*) FILTER (length(o_orderpriority) > 8) FROM orders
    UNION ALL SELECT 'unique:o_orderkey', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'unique:o_custkey,o_orderdate', count(*) FROM
      (SELECT o_custkey, o_orderdate FROM orders GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'references:o_custkey', count(*) FROM orders WHERE o_custkey IS NOT NULL
      AND o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""",
)
def dq_4(spark, directory):
    rules = [
        q.NotNull("o_orderdate"),
        q.MaxLength("o_orderpriority", 8),
        q.Unique(("o_orderkey",)),
        q.Unique(("o_custkey", "o_orderdate")),
        q.References("o_custkey", raw(spark, directory, "events"), "user_id"),
    ]
    return q.constraint_report(raw(spark, directory, "orders"), rules)


@star_query(
    "dq_5",
    """SELECT 'dim_users' AS tbl, count(*) AS cnt FROM dim_users UNION ALL SELECT 'dim_features', count(*) FROM dim_features
    UNION ALL SELECT 'dim_campaigns', count(*) FROM dim_campaigns""",
)
def dq_5(star: Star) -> DataFrame:
    names = ("dim_users", "dim_features", "dim_campaigns")
    return q.table_counts({n: w.require_rows(star.tables()[n], n) for n in names})


# -- document ingestion -----------------------------------------------------------------------------------

_CHUNKS_SQL = """pieces AS (SELECT doc_id, i AS chunk_no, substring(text, CAST(i * 512 + 1 AS BIGINT), 512) AS content
  FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 511) // 512)) AS i FROM documents WHERE length(text) > 0)
  WHERE regexp_matches(substring(text, CAST(i * 512 + 1 AS BIGINT), 512), '\\S'))"""


def text_chunks(spark: SparkSession, directory: str) -> DataFrame:
    return chunked(all_texts(spark, directory), "text", 512, ["doc_id"])


@query(
    "tx_8",
    f"""WITH {_CHUNKS_SQL},
    terms AS (SELECT doc_id, chunk_no, list_transform({tokens_sql("content")},
      lambda t: CAST('0x' || substr(md5(t), 1, 8) AS UBIGINT) % 64) AS b FROM pieces),
    counted AS (SELECT doc_id, chunk_no, list_transform(range(0, 64), lambda k: len(list_filter(b, lambda x: x = k))) AS n FROM terms)
    SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, 64 AS dims, list_sum(n) > 0 AS has_direction, array_to_string(n, ' ') AS counts,
      array_to_string(list_transform(n, lambda x: CAST(round(1000 * x / greatest(sqrt(list_sum(list_transform(n, lambda y: y * y))), 1)) AS BIGINT)), ' ') AS thousandths
    FROM counted""",
)
def tx_8(spark, directory):
    counted = text_chunks(spark, directory).withColumn("counts", bucket_counts(F.col("content"))).drop("content")
    # Thousandths are rounded from doubles: a stored float may lie on the other side of a half.
    pieces = counted.withColumn("embedding", unit_vector(F.col("counts")).cast("array<float>"))
    length = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return pieces.select(
        "doc_id",
        F.col("chunk_no").cast("bigint").alias("chunk_no"),
        F.size("embedding").alias("dims"),
        (F.round(length, 5) == 1.0).alias("has_direction"),
        F.array_join(F.transform("counts", lambda n: n.cast("string")), " ").alias("counts"),
        F.array_join(F.transform(unit_vector(F.col("counts"), 1000), lambda x: F.round(x).cast("bigint").cast("string")), " ").alias("thousandths"),
    )


@query(
    "tx_9",
    f"""WITH {_CHUNKS_SQL} SELECT row_number() OVER (ORDER BY doc_id, chunk_no) AS id, doc_id, content, 64 AS dims FROM pieces""",
)
def tx_9(spark, directory):
    path = work_path(spark, "documents")
    # Numbered first: the layout of the ids samples its input, which should not embed anything.
    numbered = assign_ids(text_chunks(spark, directory), 0, ["doc_id", "chunk_no"], "id")
    w.append(numbered.select("id", "doc_id", "content", hashed_vector(F.col("content")).alias("embedding")), path)
    stored = spark.read.parquet(path)
    return stored.select("id", "doc_id", "content", F.size("embedding").alias("dims"))
