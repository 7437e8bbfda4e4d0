"""Telemetry documents, filters, access-log lines and product documents."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import in_zone
from tidemark.operators import telemetry as t
from tidemark.sources.schemas import PRODUCT_DOCUMENT
from tidemark.streaming import sync
from tidemark.sources.folders import partition_values
from tidemark.streaming.telemetry import ingest_signals, signal_tables


def attrs(**pairs):
    return [{"key": k.replace("_", "."), "value": v} for k, v in pairs.items()]


def resource(service):
    return {"attributes": attrs(service_name={"stringValue": service})}


SECOND = 1_700_000_000
LOGS = {
    "resourceLogs": [
        {
            "resource": resource("cart"),
            "scopeLogs": [
                {
                    "scope": {"name": "a"},
                    "logRecords": [
                        {"timeUnixNano": f"{SECOND}123456789", "body": {"stringValue": "hi"}, "attributes": attrs(n={"intValue": "5"})},
                        {"timeUnixNano": "0", "body": {"boolValue": True}},
                    ],
                },
                {"scope": {"name": "b"}, "logRecords": [{"timeUnixNano": f"{SECOND}000000000", "body": {"doubleValue": 1.5}}]},
            ],
        },
        {"resource": resource("currency"), "scopeLogs": [{"logRecords": [{"timeUnixNano": "0"}]}]},
        {"scopeLogs": [{"logRecords": [{"timeUnixNano": f"{SECOND}000000000"}]}]},
    ]
}
TRACES = {
    "resourceSpans": [
        {
            "resource": resource("currency"),
            "scopeSpans": [
                {
                    "spans": [
                        {
                            "traceId": "t", "spanId": "s", "parentSpanId": "p", "name": "GET", "kind": 2,
                            "startTimeUnixNano": "1000", "endTimeUnixNano": "4500", "status": {"code": 2, "message": "no"},
                        }
                    ]
                }
            ],
        }
    ]
}
METRICS = {
    "resourceMetrics": [
        {
            "resource": resource("cart"),
            "scopeMetrics": [
                {
                    "metrics": [
                        {"name": "g", "unit": "1", "gauge": {"dataPoints": [{"timeUnixNano": "0", "asDouble": 1.5}, {"timeUnixNano": "0", "asInt": "7"}]}},
                        {"name": "s", "sum": {"dataPoints": [{"timeUnixNano": "0", "asInt": "3", "attributes": attrs(x={"stringValue": "y"})}]}},
                        {"name": "h", "histogram": {"dataPoints": [{"timeUnixNano": "0", "count": "4", "sum": 10.0}]}},
                    ]
                }
            ],
        }
    ]
}


def read(spark, work, signal, document):
    (path := f"{work}/{signal}.json") and open(path, "w").write(json.dumps(document) + "\n")
    return spark.read.schema(t.OTLP[signal]).json(path)


def test_logs(spark, work):
    found = t.flatten_logs(read(spark, work, "logs", LOGS)).collect()
    assert [(r["service_name"], r["scope_name"], r["body"]) for r in found] == [
        ("cart", "a", "hi"), ("cart", "a", "true"), ("cart", "b", "1.5"), ("currency", None, None), (None, None, None),
    ]
    assert str(found[0]["timestamp"]) == "2023-11-14 22:13:20.123456"
    assert found[0]["log_attributes"] == {"n": "5"}


def test_only_logs_lose_the_broken_service(spark, work):
    logs = t.run_pipeline(read(spark, work, "logs", LOGS), "logs")
    assert [r["service_name"] for r in logs.collect()] == ["cart", "cart", "cart", None]
    assert t.run_pipeline(read(spark, work, "traces", TRACES), "traces").count() == 1
    assert t.drop_zero_time(logs).count() == 3


def test_traces_and_metrics(spark, work):
    span = t.flatten_traces(read(spark, work, "traces", TRACES)).first()
    assert (span["span_name"], span["duration_nanos"], span["status_code"], span["parent_span_id"]) == ("GET", 3500, 2, "p")
    points = t.flatten_metrics(read(spark, work, "metrics", METRICS)).collect()
    assert [(r["metric_name"], r["metric_kind"], r["value"], r["count"]) for r in points] == [
        ("g", "gauge", 1.5, None), ("g", "gauge", 7.0, None), ("s", "sum", 3.0, None), ("h", "histogram", 10.0, 4),
    ]
    assert points[2]["point_attributes"] == {"x": "y"}


def test_three_streams(spark, work):
    for signal, document in {"logs": LOGS, "traces": TRACES, "metrics": METRICS}.items():
        spark.createDataFrame([(json.dumps(document),)], "value string").write.text(f"{work}/in/{signal}")
    inputs = {s: f"{work}/in/{s}" for s in t.OTLP}
    for _ in range(2):  # the second run finds nothing new
        sync.wait(ingest_signals(spark, inputs, f"{work}/out", f"{work}/checkpoints"))
    tables = signal_tables(spark, f"{work}/out")
    assert [tables[s].current().count() for s in ("logs", "traces", "metrics")] == [4, 1, 4]


def test_undecided_records_are_kept(spark):
    df = spark.sql(
        "SELECT 1 AS id, map('service.name', 'currency') AS resource_attributes "
        "UNION ALL SELECT 2, map('other', 'x') UNION ALL SELECT 3, CAST(NULL AS map<string,string>)"
    )
    assert {r["id"] for r in t.drop_resource(df, "service.name", "currency").collect()} == {2, 3}


LINE = (
    '[2024-05-01T10:00:00.250Z] "GET /api/cart?x=1 HTTP/1.1" 503 UF upstream_reset - "connection refused" 12 340 56 55 '
    '"10.1.1.1" "Mozilla/5.0 (X11)" "req-1" "shop:8080" "10.0.0.1:80" frontend 10.0.0.2:1 10.0.0.3:2 10.0.0.4:3 - route-a\n'
)


def test_access_log(spark):
    df = spark.createDataFrame([(1, LINE), (2, "not a log line"), (3, None)], "id int, line string")
    first, second, third = t.parse_access_log(df, "line").orderBy("id").collect()
    assert str(first["start_time"]) == "2024-05-01 10:00:00.250000"
    assert (first["method"], first["path"], first["protocol"]) == ("GET", "/api/cart?x=1", "HTTP/1.1")
    assert (first["response_code"], first["bytes_sent"], first["duration_ms"]) == (503, 340, 56)
    assert (first["user_agent"], first["requested_server_name"], first["route_name"]) == ("Mozilla/5.0 (X11)", None, "route-a")
    for row in (second, third):
        assert all(row[name] is None for name, _ in t.ACCESS_LOG_FIELDS)


def test_products(spark):
    product = {
        "id": "A", "name": "Scope", "priceUsd": {"currencyCode": "USD", "units": 101, "nanos": 960000000},
        "categories": ["telescopes", "travel"],
    }
    bare = {"id": "B", "name": "Bag", "priceUsd": {"currencyCode": "USD", "units": 3, "nanos": 0}, "categories": []}
    df = spark.createDataFrame([(json.dumps(product),), (json.dumps(bare),)], "j string")
    found = t.flatten_products(df, "j", PRODUCT_DOCUMENT).orderBy("id", "category").collect()
    assert [(r["id"], r["price"], r["category"]) for r in found] == [
        ("A", Decimal("101.96"), "telescopes"), ("A", Decimal("101.96"), "travel"), ("B", Decimal("3"), None),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_zone_change_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS ts, '1700000000000000000' AS nanos")
        row = df.select(in_zone("ts", "Europe/Berlin").alias("b"), t.from_nanos(F.col("nanos")).alias("n")).first()
        assert (str(row["b"]), str(row["n"])) == ("2024-03-10 03:30:00", "2023-11-14 22:13:20")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_all_kinds_of_values_and_metrics_arrive(spark):
    values = {
        "list": {"arrayValue": {"values": [{"intValue": "1"}, {"stringValue": "a"}]}},
        "pairs": {"kvlistValue": {"values": [{"key": "k", "value": {"boolValue": True}}]}},
        "raw": {"bytesValue": "AQI="},
        "twice": {"stringValue": "first"},
    }
    attributes = [{"key": k, "value": v} for k, v in values.items()] + [{"key": "twice", "value": {"stringValue": "last"}}, {"value": {"intValue": "3"}}]
    log = {"resourceLogs": [{"resource": resource("s"), "scopeLogs": [{"scope": {"name": "a"}, "logRecords": [
        {"timeUnixNano": "0", "body": values["pairs"], "attributes": attributes}]}]}]}
    df = spark.read.schema(t.OTLP["logs"]).json(spark.sparkContext.parallelize([json.dumps(log)]))
    row = t.flatten_logs(df).first()
    assert json.loads(row["body"]) == values["pairs"]["kvlistValue"]
    found = row["log_attributes"]
    assert json.loads(found["list"]) == values["list"]["arrayValue"] and found["raw"] == "AQI=" and found["twice"] == "last" and len(found) == 4

    point = {"timeUnixNano": "0", "count": "4", "sum": 2.5, "attributes": []}
    kinds = ["histogram", "exponentialHistogram", "summary"]
    metric = {"resourceMetrics": [{"resource": resource("s"), "scopeMetrics": [{"scope": {"name": "a"}, "metrics": [
        {"name": k, k: {"dataPoints": [point]}} for k in kinds]}]}]}
    df = spark.read.schema(t.OTLP["metrics"]).json(spark.sparkContext.parallelize([json.dumps(metric)]))
    assert sorted((r["metric_kind"], r["value"], r["count"]) for r in t.flatten_metrics(df).collect()) == sorted((k, 2.5, 4) for k in kinds)


def test_events_are_shared_before_their_texts_are_made(spark, tmp_path):
    """One small file of events is one task; its texts, many times as large, are to be made by all."""
    from tidemark.catalog import streams

    events = spark.range(100).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.5D AS value", "'{}' AS props"
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    for paths in (streams.whole_documents(spark, str(tmp_path)), streams.export_documents(spark, str(tmp_path))):
        for path in paths.values():
            plan = spark.read.text(path)
            assert plan.count() == 100 and len(plan.inputFiles()) >= streams.MESSAGE_FILES
    dealt = streams.dealt_events(spark, str(tmp_path))
    assert dealt.rdd.getNumPartitions() >= streams.MESSAGE_FILES and dealt.count() == 100


@pytest.mark.parametrize("name, signal", [("tel_4", "traces"), ("tel_5", "logs")])
def test_a_query_streams_only_the_signals_it_reads(spark, monkeypatch, name, signal):
    from tidemark.catalog import QUERIES, streams

    started = []
    monkeypatch.setattr(streams, "ingest_signals", lambda spark, inputs, *rest, **more: started.extend(inputs) or ingest_signals(spark, inputs, *rest, **more))
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert started == [signal]


def test_whole_documents_lie_compressed_and_go_through_in_batches(spark, tmp_path, monkeypatch):
    """Texts are many times the events and shuffled rows are as many: neither is to lie on disk at once in full."""
    from tidemark.catalog import QUERIES, streams

    events = spark.range(400).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.5D AS value", "'{}' AS props"
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(streams, "WHOLE_FILE_RECORDS", 25)
    monkeypatch.setattr(streams, "WHOLE_BATCH_BYTES", 3_000)
    inputs, out = {}, []
    monkeypatch.setattr(streams, "ingest_signals", lambda spark, paths, to, *rest, **more: (inputs.update(paths), out.append(to), ingest_signals(spark, paths, to, *rest, **more))[-1])
    found = {r["part"]: (r["rows"], r["numbers"]) for r in QUERIES["tel_1_whole"](spark, str(tmp_path)).collect()}
    ids = sum(range(400))
    assert found["span events"] == (400, ids) and found["links"] == (800, 2 * ids) and found["gauge"] == (400, 600)
    assert found["histogram"] == (400, ids + 400 * 8) and len(found) == 7
    for signal, path in inputs.items():
        per_file = spark.read.text(path).groupBy(F.input_file_name().alias("file")).count().collect()
        assert sum(r["count"] for r in per_file) == 400 and all(r["count"] <= 25 and r["file"].endswith(".gz") for r in per_file)
        assert len(partition_values(spark, f"{out[0]}/otel_{signal}/rows/event_date=2024-01-01", "batch")) > 1
