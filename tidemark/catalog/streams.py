"""Streaming jobs, run over all present input and compared with the batch answer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import changes as ch, quality as q
from ..operators.activity import count_by
from ..operators.telemetry import OTLP
from ..plans import analytics as a
from ..session import checkpointed, work_path
from ..sources import writers as w
from ..sources.readers import read_json_stream, read_table_stream
from ..sources.schemas import EVENT_MESSAGE, STAR_KEYS, STAR_SCHEMAS, conform
from ..sources.star import raw, star_from_shop
from ..streaming import live, sync
from ..streaming.dated import DatedTable
from ..streaming.states import ActivityStates, track_activity
from ..streaming.tables import ChangeTable
from ..streaming.telemetry import ingest_signals, signal_tables
from .base import NOW, STAR, query, stamp
from .ingestion import CHANGES_SQL, ROW, applied_sql, envelopes, user_base

MESSAGE_FILES = 8
WHOLE_FILE_RECORDS = 100_000  # some MB a file, compressed, of documents with all that a signal can hold
WHOLE_BATCH_BYTES = 256 * 1024 * 1024  # what a batch of such files shuffles is a few times that


def send(messages: DataFrame, path: str, dealt: bool = False, records_per_file: int | None = None) -> str:
    """Write one text column as message files for a stream to pick up; messages of rows ``dealt`` before are not moved.

    With ``records_per_file`` files are compressed; none can be split then, so their number grows with the messages.
    """
    writer = (messages if dealt else messages.repartition(MESSAGE_FILES)).write
    if records_per_file:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
    writer.text(path)
    return path


def dealt_events(spark: SparkSession, directory: str) -> DataFrame:
    """Events shared among all cores, and MESSAGE_FILES at least, before texts many times their size are made of them."""
    events = raw(spark, directory, "events")
    parts = max(MESSAGE_FILES, spark.sparkContext.defaultParallelism)
    return events if events.rdd.getNumPartitions() >= parts else events.repartition(parts)


def event_messages(spark: SparkSession, directory: str) -> DataFrame:
    facts = conform(star_from_shop(spark, directory).fact_events, "fact_events")
    written = facts.withColumn("event_time", F.col("event_time").cast("string"))
    return written.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def received_events(spark: SparkSession, directory: str, **options) -> str:
    """All event messages through the stream into an append table; returns its path."""
    root = work_path(spark, "messages")
    stream = read_json_stream(spark, send(event_messages(spark, directory), f"{root}/in"), EVENT_MESSAGE, ["event_time"], 3)
    sync.wait([sync.append_stream(stream, f"{root}/out", f"{root}/checkpoint", **options)])
    return f"{root}/out"


def user_table(spark: SparkSession, directory: str) -> ChangeTable:
    """The user table with its initial snapshot loaded."""
    table = ChangeTable(spark, work_path(spark, "users"), ROW, ["user_id"])
    table.load_snapshot(user_base(spark, directory))
    return table


def change_stream(spark: SparkSession, directory: str, files: int | None = 3) -> DataFrame:
    path = send(envelopes(spark, directory), work_path(spark, "changes"))
    reader = spark.readStream.format("text")
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return ch.decode_changes(reader.load(path), "value", ROW, ["user_id"])


_EVENTS = f"""SELECT event_id, user_id, feature_id, campaign_id, session_id, event_type,
  {stamp("event_time")} AS event_time, properties FROM fact_events"""
_EVENT_COLUMNS = [
    "event_id", "user_id", "feature_id", "campaign_id", "session_id", "event_type", "event_time", "properties",
]


@query("src_3", STAR + _EVENTS)
def src_3(spark, directory):
    return spark.read.parquet(received_events(spark, directory)).select(*_EVENT_COLUMNS)


ORDER_ROW = "order_id bigint, user_id bigint, total double"


#: What each of the five tables is checked by.
CHECKED = {
    "dim_users": "user_id", "dim_features": "feature_id", "dim_campaigns": "length(channel)", "fact_events": "event_id", "fact_conversions": "conversion_id",
}


@query(
    "ing_9",
    f"""{STAR} SELECT 'dim_users' AS tbl, count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS check_sum FROM dim_users WHERE plan <> 'MACHINERY'
    UNION ALL SELECT 'dim_features', count(*), CAST(sum(feature_id) AS BIGINT) FROM dim_features
    UNION ALL SELECT 'dim_campaigns', count(*), CAST(sum(length(channel) + 1) AS BIGINT) FROM dim_campaigns
    UNION ALL SELECT 'fact_events', count(*), CAST(sum(event_id) AS BIGINT) FROM fact_events
    UNION ALL SELECT 'fact_conversions', count(*), CAST(sum(conversion_id) AS BIGINT) FROM fact_conversions""",
)
def ing_9(spark, directory):
    # One source for five tables: all rows created, then users of one plan deleted and every campaign renamed.
    root, star = work_path(spark, "five"), star_from_shop(spark, directory)
    messages = None
    for name in STAR_SCHEMAS:
        rows = conform(getattr(star, name), name)
        row = F.struct("*")
        steps = [(rows, "c", 1, F.when(F.lit(False), row), row)]
        if name == "dim_users":
            steps.append((rows.where("plan = 'MACHINERY'"), "d", 2, row, F.when(F.lit(False), row)))
        if name == "dim_campaigns":
            steps.append((rows.withColumn("channel", F.concat("channel", F.lit("!"))), "u", 2, row, row))
        for part, op, seq, before, after in steps:
            change = ch.encode_changes(part, F.lit(op), F.lit(seq).cast("bigint"), before, after)
            line = change.select(F.to_json(F.struct(F.lit(name).alias("table"), F.col("value"))).alias("value"))
            messages = line if messages is None else messages.unionByName(line)
    send(messages, f"{root}/in")
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", MESSAGE_FILES // 2).load(f"{root}/in")
    source = lines.select(F.from_json("value", "table string, value string").alias("m")).select("m.*")
    tables = {n: ChangeTable(spark, f"{root}/{n}", ddl, STAR_KEYS[n]) for n, ddl in STAR_SCHEMAS.items()}
    sync.wait([sync.fan_out(source, tables, f"{root}/checkpoint", "(dim|fact)_.*")])
    return q.stacked(
        [
            t.current().agg(F.count(F.lit(1)).alias("rows"), F.sum(F.expr(CHECKED[n])).cast("bigint").alias("check_sum")).select(
                F.lit(n).alias("tbl"), "rows", "check_sum"
            )
            for n, t in tables.items()
        ]
    )


@query(
    "ing_9_separate",
    f"""{CHANGES_SQL}, users AS ({applied_sql()}) SELECT 'users' AS tbl, count(*) AS rows, CAST(sum(position) AS BIGINT) AS check_sum FROM users
    UNION ALL SELECT 'orders', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders WHERE o_orderstatus <> 'F'""",
)
def ing_9_separate(spark, directory):
    orders = raw(spark, directory, "orders")
    row = F.struct(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("total")
    )
    nothing = F.when(F.lit(False), row)
    created = ch.encode_changes(orders, F.lit("c"), F.lit(1).cast("bigint"), nothing, row)
    closed = ch.encode_changes(
        orders.where("o_orderstatus = 'F'"), F.lit("d"), F.lit(2).cast("bigint"), row, nothing
    )
    path = send(created.unionByName(closed), work_path(spark, "orders"))
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 3).load(path)
    tables = {
        "users": user_table(spark, directory),
        "orders": ChangeTable(spark, work_path(spark, "orders"), ORDER_ROW, ["order_id"]),
    }
    specs = [
        sync.TableSync("users", change_stream(spark, directory), tables["users"]),
        sync.TableSync("orders", ch.decode_changes(stream, "value", ORDER_ROW, ["order_id"]), tables["orders"]),
    ]
    sync.wait(sync.sync_tables(specs, work_path(spark, "checkpoints")))
    sums = {"users": "position", "orders": "user_id"}
    return q.stacked(
        [
            t.current().agg(F.count(F.lit(1)).alias("rows"), F.sum(sums[n]).alias("check_sum")).select(
                F.lit(n).alias("tbl"), "rows", "check_sum"
            )
            for n, t in tables.items()
        ]
    )


@query("ing_17", "SELECT event_type, count(*) AS rows FROM events GROUP BY 1")
def ing_17(spark, directory):
    # The second run starts from the first one's checkpoint and finds nothing left to do.
    root = work_path(spark, "progress")
    events = raw(spark, directory, "events")
    for _ in range(2):
        stream = read_table_stream(spark, f"{directory}/events.parquet*", events.schema)
        sync.wait([sync.append_stream(stream, f"{root}/out", f"{root}/checkpoint")])
    return count_by(spark.read.parquet(f"{root}/out"), ["event_type"], "rows")


@query("ing_18", CHANGES_SQL + applied_sql())
def ing_18(spark, directory):
    # The whole change log is delivered again under the batch id it already had.
    table = user_table(spark, directory)
    log = ch.decode_changes(envelopes(spark, directory), "value", ROW, ["user_id"])
    for _ in range(2):
        table.append_batch(log, 0)
    table.compact()
    table.append_batch(log, 0)
    return table.current()


def _file_sizes(spark: SparkSession, path: str, limit: int) -> DataFrame:
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > limit).alias("files_over_limit"))


@query(
    "ing_19",
    """SELECT count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS check_sum, CAST(0 AS BIGINT) AS files_over_limit,
    CAST(0 AS BIGINT) AS days_left_in_pieces FROM events""",
)
def ing_19(spark, directory):
    # Batches are admitted by bytes; what they wrote is packed, and the files are then counted by size and by day.
    root, facts = work_path(spark, "admitted"), conform(star_from_shop(spark, directory).fact_events, "fact_events")
    messages = send(event_messages(spark, directory), f"{root}/in")
    stream = read_json_stream(spark, messages, EVENT_MESSAGE, ["event_time"], bytes_per_trigger=sync.FLUSH_BYTES)
    table = DatedTable(spark, f"{root}/out", facts.schema, "event_time")
    sync.wait([sync.dated_stream(stream, table, f"{root}/checkpoint")])
    return _packed(table, F.col("event_id"))


def _packed(table: DatedTable, number) -> DataFrame:
    """Pack a table to the flush size; its rows, files beyond twice that size, and days of more files than batch and bytes need."""
    table.pack(sync.FLUSH_BYTES)
    table.clean()
    per_day = table.files().groupBy(F.regexp_extract("path", r"event_date=([^/]+)/", 1).alias("day")).agg(
        F.count_if(F.col("length") > 2 * sync.FLUSH_BYTES).alias("large"),
        (F.count(F.lit(1)) > 3 + F.ceil(F.sum("length") / sync.FLUSH_BYTES)).alias("pieces"),
    )
    sizes = per_day.agg(F.sum("large").alias("files_over_limit"), F.count_if("pieces").alias("days_left_in_pieces"))
    rows = table.current().agg(F.count(F.lit(1)).alias("rows"), F.sum(number).cast("bigint").alias("check_sum"))
    return rows.crossJoin(sizes)  # one row each


@query("ing_19_records", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS files_over_limit FROM events")
def ing_19_records(spark, directory):
    path = received_events(spark, directory, records_per_file=sync.FLUSH_RECORDS)
    return _file_sizes(spark, path, sync.FLUSH_RECORDS)


# -- telemetry --------------------------------------------------------------------------------------------

SERVICE = "CASE WHEN event_type = 'error' THEN 'currency' ELSE event_type END"


def export_documents(spark: SparkSession, directory: str, signals: Iterable[str] = tuple(OTLP)) -> dict[str, str]:
    """Each event as a log record, a span and a gauge point, in OTLP/JSON files of the named signals."""
    root = work_path(spark, "otlp")
    events = dealt_events(spark, directory)
    service = F.when(F.col("event_type") == "error", "currency").otherwise(F.col("event_type"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    nanos = F.concat(micros.cast("string"), F.lit("000"))

    def attribute(key: str, value):
        return F.struct(F.lit(key).alias("key"), F.struct(value.cast("string").alias("stringValue")).alias("value"))

    resource = F.struct(F.array(attribute("service.name", service)).alias("attributes"))
    scope = F.struct(F.lit("shop").alias("name"), F.lit("1").alias("version"))
    record = F.struct(
        nanos.alias("timeUnixNano"),
        F.lit(9).alias("severityNumber"),
        F.lit("INFO").alias("severityText"),
        F.struct(F.col("props").alias("stringValue")).alias("body"),
        F.array(attribute("user", F.col("user_id"))).alias("attributes"),
        F.col("event_id").cast("string").alias("traceId"),
        F.col("event_id").cast("string").alias("spanId"),
    )
    span = F.struct(
        F.col("event_id").cast("string").alias("traceId"),
        F.col("event_id").cast("string").alias("spanId"),
        F.col("event_type").alias("name"),
        F.lit(1).alias("kind"),
        nanos.alias("startTimeUnixNano"),
        F.concat((micros + F.col("user_id")).cast("string"), F.lit("000")).alias("endTimeUnixNano"),
        F.array(attribute("user", F.col("user_id"))).alias("attributes"),
    )
    point = F.struct(nanos.alias("timeUnixNano"), F.col("value").alias("asDouble"))
    metric = F.struct(
        F.lit("amount").alias("name"), F.lit("1").alias("unit"), F.struct(F.array(point).alias("dataPoints")).alias("gauge")
    )
    shapes = {
        "logs": ("resourceLogs", "scopeLogs", "logRecords", record),
        "traces": ("resourceSpans", "scopeSpans", "spans", span),
        "metrics": ("resourceMetrics", "scopeMetrics", "metrics", metric),
    }
    paths = {}
    for signal in signals:
        outer, inner, leaf, body = shapes[signal]
        scoped = F.struct(scope.alias("scope"), F.array(body).alias(leaf))
        document = F.struct(F.array(F.struct(resource.alias("resource"), F.array(scoped).alias(inner))).alias(outer))
        paths[signal] = send(events.select(F.to_json(document).alias("value")), f"{root}/{signal}", dealt=True)
    return paths


def ingested(spark: SparkSession, directory: str, signals: Iterable[str] = tuple(OTLP), **options) -> dict[str, DatedTable]:
    """The tables of the signals, each fed by a stream of its own; a query streams those that it reads."""
    root = work_path(spark, "otel")
    sync.wait(ingest_signals(spark, export_documents(spark, directory, signals), root, f"{root}/checkpoints", **options))
    tables = signal_tables(spark, root)
    return {signal: tables[signal] for signal in signals}


@query(
    "tel_1",
    f"""SELECT 'logs' AS signal, {SERVICE} AS service_name, count(*) AS rows, min({stamp("ts")}) AS first_seen,
      CAST(sum(event_id) AS DOUBLE) AS check_sum FROM events WHERE event_type <> 'error' GROUP BY 2
    UNION ALL SELECT 'traces', {SERVICE}, count(*), min({stamp("ts")}), CAST(sum(user_id) * 1000 AS DOUBLE) FROM events GROUP BY 2
    UNION ALL SELECT 'metrics', {SERVICE}, count(*), min({stamp("ts")}), round(sum(value), 2) FROM events GROUP BY 2""",
)
def tel_1(spark, directory):
    tables = ingested(spark, directory)
    sums = {
        "logs": F.sum(F.col("trace_id").cast("bigint")).cast("double"),
        "traces": F.sum("duration_nanos").cast("double"),
        "metrics": F.round(F.sum("value"), 2),
    }
    return q.stacked(
        [
            tables[signal].current()
            .groupBy("service_name")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_seen"), total.alias("check_sum"))
            .withColumn("signal", F.lit(signal))
            for signal, total in sums.items()
        ]
    )


@query(
    "tel_3",
    """SELECT 'logs' AS signal, count(*) FILTER (event_type = 'error') * 0 AS dropped_service, count(*) FILTER (event_type <> 'error') AS others FROM events
    UNION ALL SELECT 'traces', count(*) FILTER (event_type = 'error'), count(*) FILTER (event_type <> 'error') FROM events
    UNION ALL SELECT 'metrics', count(*) FILTER (event_type = 'error'), count(*) FILTER (event_type <> 'error') FROM events""",
)
def tel_3(spark, directory):
    tables = ingested(spark, directory)
    dropped = F.col("service_name") == "currency"
    return q.stacked(
        [
            tables[signal].current()
            .agg(F.count_if(dropped).alias("dropped_service"), F.count_if(~dropped).alias("others"))
            .withColumn("signal", F.lit(signal))
            for signal in OTLP
        ]
    )


def whole_documents(spark: SparkSession, directory: str) -> dict[str, str]:
    """Each event as a span with an event and two links, and as one data point of each kind with all that the kind holds."""
    root, events = work_path(spark, "whole"), dealt_events(spark, directory)
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    nanos, number = F.concat(micros.cast("string"), F.lit("000")), F.col("event_id").cast("string")
    resource = F.expr("named_struct('attributes', array(named_struct('key', 'service.name', 'value', named_struct('stringValue', event_type))))")
    scope = F.expr("named_struct('name', 'shop', 'version', '2', 'attributes', array(named_struct('key', 'k', 'value', named_struct('intValue', user_id))))")
    link = F.struct(number.alias("traceId"), F.lit("w=1").alias("traceState"))
    span = F.struct(
        number.alias("traceId"),
        nanos.alias("startTimeUnixNano"),
        nanos.alias("endTimeUnixNano"),
        F.array(F.struct(nanos.alias("timeUnixNano"), F.col("event_type").alias("name"))).alias("events"),
        F.array(link, link).alias("links"),
    )
    side = F.struct(F.lit(2).alias("offset"), F.array(F.lit("1"), number).alias("bucketCounts"))
    exemplar = F.array(F.struct(nanos.alias("timeUnixNano"), F.col("value").alias("asDouble"), number.alias("traceId")))
    at, total = nanos.alias("timeUnixNano"), [F.lit("3").alias("count"), F.col("value").alias("sum")]
    kinds = {
        "gauge": [at, F.col("value").alias("asDouble")],
        "sum": [at, number.alias("asInt"), exemplar.alias("exemplars")],
        "histogram": [at, *total, F.array(number, F.lit("2")).alias("bucketCounts"), F.array(F.col("value")).alias("explicitBounds")],
        "exponentialHistogram": [at, *total, F.lit(3).alias("scale"), F.lit("5").alias("zeroCount"), side.alias("positive"), side.alias("negative")],
        "summary": [at, *total, F.array(F.struct(F.lit(0.5).alias("quantile"), F.col("value"))).alias("quantileValues")],
    }
    metrics = [
        F.struct(
            F.lit(kind).alias("name"),
            F.struct(
                F.array(F.struct(*fields)).alias("dataPoints"), F.lit(2).alias("aggregationTemporality"), (F.col("user_id") % 2 == 0).alias("isMonotonic")
            ).alias(kind),
        )
        for kind, fields in kinds.items()
    ]
    # The kinds differ in their fields, so their JSON texts are put together.
    each = F.concat(F.lit("["), F.concat_ws(",", *[F.to_json(m) for m in metrics]), F.lit("]"))
    head = F.concat(F.lit('[{"resource":'), F.to_json(resource))
    documents = {
        "traces": F.concat(F.lit('{"resourceSpans":'), head, F.lit(',"scopeSpans":[{"scope":'), F.to_json(scope), F.lit(',"spans":['), F.to_json(span), F.lit("]}]}]}")),
        "metrics": F.concat(F.lit('{"resourceMetrics":'), head, F.lit(',"scopeMetrics":[{"scope":'), F.to_json(scope), F.lit(',"metrics":'), each, F.lit("}]}]}")),
    }
    return {
        signal: send(events.select(text.alias("value")), f"{root}/{signal}", dealt=True, records_per_file=WHOLE_FILE_RECORDS)
        for signal, text in documents.items()
    }


@query(
    "tel_1_whole",
    """SELECT part, rows, CAST(round(numbers, 2) AS DOUBLE) AS numbers FROM (
    SELECT 'span events' AS part, count(*) AS rows, sum(event_id) AS numbers FROM events
    UNION ALL SELECT 'links', count(*) * 2, sum(event_id) * 2 FROM events
    UNION ALL SELECT 'gauge', count(*), sum(value) FROM events
    UNION ALL SELECT 'sum', count(*), sum(event_id + value) + sum(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END) FROM events
    UNION ALL SELECT 'histogram', count(*), sum(event_id + 2 + value + 3 + value) FROM events
    UNION ALL SELECT 'exponentialHistogram', count(*), sum(value + 3 + 3 + 5 + 2 * (2 + 1 + event_id)) FROM events
    UNION ALL SELECT 'summary', count(*), sum(value + 3 + 0.5 + value) FROM events)""",
)
def tel_1_whole(spark, directory):
    # What each kind holds beyond its number comes back whole from the streamed tables.
    root = work_path(spark, "otel")
    inputs = whole_documents(spark, directory)
    sync.wait(ingest_signals(spark, inputs, root, f"{root}/checkpoints", bytes_per_trigger=WHOLE_BATCH_BYTES))
    tables = signal_tables(spark, root)
    spans, points = tables["traces"].current(), tables["metrics"].current()
    rows, add = F.count(F.lit(1)).alias("rows"), lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    side = lambda c: c["offset"] + add(c["bucket_counts"])
    numbers = {
        "gauge": F.col("value"),
        "sum": F.col("value") + F.col("exemplars")[0]["value"] + F.col("is_monotonic").cast("int"),
        "histogram": F.col("value") + F.col("count") + add(F.col("bucket_counts")) + add(F.col("explicit_bounds")),
        "exponentialHistogram": F.col("value") + F.col("count") + F.col("scale") + F.col("zero_count") + side(F.col("positive")) + side(F.col("negative")),
        "summary": F.col("value") + F.col("count") + F.col("quantiles")[0]["quantile"] + F.col("quantiles")[0]["value"],
    }
    chosen = F.coalesce(*[F.when(F.col("metric_kind") == kind, number) for kind, number in numbers.items()])
    kinds = points.groupBy(F.col("metric_kind").alias("part")).agg(rows, F.round(F.sum(chosen), 2).alias("numbers"))
    events = spans.where("span_name IS NULL").select("trace_id", F.explode("events").alias("e")).where("e.timestamp IS NOT NULL")
    links = spans.select(F.explode("links").alias("k")).where("k.trace_state = 'w=1'")
    return q.stacked(
        [
            kinds,
            events.agg(rows, F.sum(F.col("trace_id").cast("double")).alias("numbers")).select(F.lit("span events").alias("part"), "rows", "numbers"),
            links.agg(rows, F.sum(F.col("k.trace_id").cast("double")).alias("numbers")).select(F.lit("links").alias("part"), "rows", "numbers"),
        ]
    )


@query(
    "tel_4",
    f"""WITH clock AS (SELECT max(ts) AS as_of FROM events)
    SELECT event_id, {stamp("ts")} AS timestamp FROM events WHERE CAST(ts AS DATE) >= CAST({NOW} AS DATE) - 7""",
)
def tel_4(spark, directory):
    # Days of the streamed table expire; the batch that is delivered again afterwards does not bring them back.
    table = ingested(spark, directory, ["traces"])["traces"]
    before = table.current()
    today = before.agg(F.max("event_date")).first()[0]
    late = checkpointed(spark, before.drop("event_date"))
    table.expire(7, today)
    table.append_batch(late, 0)
    return table.current().select(F.col("trace_id").cast("bigint").alias("event_id"), "timestamp")


@query(
    "tel_5",
    """SELECT count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS check_sum, CAST(0 AS BIGINT) AS files_over_limit,
    CAST(0 AS BIGINT) AS days_left_in_pieces FROM events WHERE event_type <> 'error'""",
)
def tel_5(spark, directory):
    table = ingested(spark, directory, ["logs"], bytes_per_trigger=sync.FLUSH_BYTES)["logs"]
    return _packed(table, F.col("trace_id").cast("bigint"))


# -- continuous results -----------------------------------------------------------------------------------


@query("st_1", CHANGES_SQL + applied_sql())
def st_1(spark, directory):
    table = user_table(spark, directory)
    sync.wait([sync.sync_table(sync.TableSync("st_1", change_stream(spark, directory), table), work_path(spark, "sync"))])
    return table.current()


@query(
    "st_2",
    f"""{STAR} SELECT event_type AS name, count(*) AS value FROM fact_events GROUP BY 1
    UNION ALL SELECT plan, count(*) FROM fact_events e JOIN dim_users u ON e.user_id = u.user_id
    WHERE event_time >= (SELECT as_of FROM clock) - INTERVAL 7 DAYS GROUP BY 1""",
)
def st_2(spark, directory):
    root = work_path(spark, "live")
    star = star_from_shop(spark, directory)
    states = ActivityStates(spark, f"{root}/states", roll_every=2)

    def results(session: SparkSession):
        # Counts by type come from the states; the last seven days from the day folders of all batches.
        now = star.replace(fact_events=session.read.parquet(f"{root}/events"))
        return {"event_types": states.by_type(), "activity_per_plan": a.activity_per_plan(now)}

    def store(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("event_date", F.to_date("event_time"))
        dated.write.mode("overwrite").partitionBy("event_date").parquet(f"{root}/events/batch={batch_id}")
        states.append_batch(batch, batch_id)

    messages = send(event_messages(spark, directory), f"{root}/in")
    arrivals = read_json_stream(spark, messages, EVENT_MESSAGE, ["event_time"], 4)
    sync.wait([live.refresh_queries(arrivals, store, results, f"{root}/results", f"{root}/checkpoint", every=None)])
    found = lambda name: w.materialized(spark, f"{root}/results", name)
    types = found("event_types").select(F.col("event_type").alias("name"), F.col("count").alias("value"))
    plans = found("activity_per_plan").select(F.col("plan").alias("name"), F.col("events").alias("value"))
    return types.unionByName(plans)


@query(
    "st_3",
    f"""{STAR} SELECT strftime(event_time, '%Y-%m-%d %H:00:00') AS hour, count(*) AS events,
    count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions FROM fact_events GROUP BY 1""",
)
def st_3(spark, directory):
    root = work_path(spark, "hours")
    # Several batches, each with events of all days: most rows come long after later ones.
    events = conform(star_from_shop(spark, directory).fact_events, "fact_events")
    events.repartition(3, "event_id").write.parquet(f"{root}/in")
    stream = read_table_stream(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema, 1)
    states = ActivityStates(spark, f"{root}/states", roll_every=2)
    sync.wait([track_activity(stream, states, f"{root}/checkpoint")])
    return states.counts(states.window(), F.col("hour"))


@query("st_4", STAR + _EVENTS)
def st_4(spark, directory):
    # Messages are delivered twice; the append table keeps both copies and the key is resolved when it is read.
    root = work_path(spark, "topic")
    messages = event_messages(spark, directory)
    path = send(messages.unionByName(messages), f"{root}/in")
    stream = read_json_stream(spark, path, EVENT_MESSAGE, ["event_time"], 3).withColumn("topic", F.lit("fact_events"))
    sent = ch.routed(stream, "topic", {"fact_events": "kafka_fact_events"})
    kept = sent.where("target_table = 'kafka_fact_events'").drop("topic", "target_table")
    sync.wait([sync.append_stream(kept, f"{root}/kafka_fact_events", f"{root}/checkpoint", records_per_file=sync.FLUSH_RECORDS)])
    log = spark.read.parquet(f"{root}/kafka_fact_events")
    return ch.read_latest(log, ["event_id"], F.desc("event_time")).select(*_EVENT_COLUMNS)
