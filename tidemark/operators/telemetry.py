"""Logs, traces and metrics in OTLP/JSON, access-log lines, and nested product documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Lists, key-value lists and bytes have no fixed depth; a string field takes them as the JSON text they came as.
_ANY = (
    "struct<stringValue:string,intValue:string,doubleValue:double,boolValue:boolean,"
    "arrayValue:string,kvlistValue:string,bytesValue:string>"
)
_ATTRIBUTES = f"array<struct<key:string,value:{_ANY}>>"
_RESOURCE = f"resource:struct<attributes:{_ATTRIBUTES}>"
_SCOPE = f"scope:struct<name:string,version:string,attributes:{_ATTRIBUTES},droppedAttributesCount:bigint>"
_EXEMPLAR = f"struct<timeUnixNano:string,asDouble:double,asInt:string,spanId:string,traceId:string,filteredAttributes:{_ATTRIBUTES}>"
_BUCKETS = "struct<offset:int,bucketCounts:array<string>>"
# Data points of all kinds in one shape: a kind leaves the fields of the others out.
_POINT = (
    f"struct<startTimeUnixNano:string,timeUnixNano:string,asDouble:double,asInt:string,count:string,sum:double,min:double,max:double,"
    f"bucketCounts:array<string>,explicitBounds:array<double>,scale:int,zeroCount:string,zeroThreshold:double,positive:{_BUCKETS},"
    f"negative:{_BUCKETS},quantileValues:array<struct<quantile:double,value:double>>,exemplars:array<{_EXEMPLAR}>,flags:bigint,"
    f"attributes:{_ATTRIBUTES}>"
)
_POINTS = f"struct<aggregationTemporality:int,isMonotonic:boolean,dataPoints:array<{_POINT}>>"
_SPAN_EVENT = f"struct<timeUnixNano:string,name:string,attributes:{_ATTRIBUTES},droppedAttributesCount:bigint>"
_LINK = f"struct<traceId:string,spanId:string,traceState:string,attributes:{_ATTRIBUTES},droppedAttributesCount:bigint,flags:bigint>"
METRIC_KINDS = ["gauge", "sum", "histogram", "exponentialHistogram", "summary"]

# Field names of the public OTLP/JSON encoding, one document per export request.
OTLP = {
    "logs": (
        f"resourceLogs array<struct<{_RESOURCE},scopeLogs:array<struct<{_SCOPE},logRecords:array<struct<"
        f"timeUnixNano:string,severityNumber:int,severityText:string,body:{_ANY},attributes:{_ATTRIBUTES},"
        "traceId:string,spanId:string,observedTimeUnixNano:string,eventName:string,flags:bigint,"
        "droppedAttributesCount:bigint>>>>>>"
    ),
    "traces": (
        f"resourceSpans array<struct<{_RESOURCE},scopeSpans:array<struct<{_SCOPE},spans:array<struct<"
        "traceId:string,spanId:string,parentSpanId:string,name:string,kind:int,startTimeUnixNano:string,"
        f"endTimeUnixNano:string,attributes:{_ATTRIBUTES},status:struct<code:int,message:string>,"
        f"traceState:string,events:array<{_SPAN_EVENT}>,links:array<{_LINK}>,flags:bigint,droppedAttributesCount:bigint,"
        "droppedEventsCount:bigint,droppedLinksCount:bigint>>>>>>"
    ),
    "metrics": (
        f"resourceMetrics array<struct<{_RESOURCE},scopeMetrics:array<struct<{_SCOPE},metrics:array<struct<"
        "name:string,unit:string,description:string," + ",".join(f"{kind}:{_POINTS}" for kind in METRIC_KINDS) + ">>>>>>"
    ),
}


def text_value(value: Column) -> Column:
    """An OTLP value of any kind as text."""
    return F.coalesce(
        value["stringValue"], value["intValue"], value["doubleValue"].cast("string"), value["boolValue"].cast("string"),
        value["arrayValue"], value["kvlistValue"], value["bytesValue"],
    )


def attribute_map(attributes: Column) -> Column:
    """Attribute list to ``map<string,string>``; of entries with one key the last counts, one without a key does not."""
    named = F.transform(
        F.filter(attributes, lambda a: a["key"].isNotNull()),
        lambda a: F.struct(a["key"].alias("key"), text_value(a["value"]).alias("value")),
    )
    keys = F.transform(named, lambda a: a["key"])
    # array_position finds the first place; in the reversed list that is the last one.
    last = F.filter(F.reverse(named), lambda a, i: F.array_position(F.reverse(keys), a["key"]) == i + 1)
    return F.map_from_entries(F.reverse(last))


def from_nanos(nanos: Column) -> Column:
    """Nanoseconds since 1970 in UTC as wall clock, whatever the session zone."""
    micros = F.floor(nanos.cast("decimal(20,0)") / F.lit(1000))
    seconds = (micros / F.lit(1_000_000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


#: What every record carries of its scope.
_OF_SCOPE = ["scope_name", "scope_version", "scope_attributes", "resource_attributes"]


def _flat(df: DataFrame, resources: str, scopes: str, records: str) -> DataFrame:
    """One row per record, with the resource attributes and the scope beside it."""
    return (
        df.select(F.explode(resources).alias("r"))
        .select(attribute_map(F.col("r.resource.attributes")).alias("resource_attributes"), F.explode(f"r.{scopes}").alias("s"))
        .select(
            "resource_attributes",
            F.col("s.scope.name").alias("scope_name"),
            F.col("s.scope.version").alias("scope_version"),
            attribute_map(F.col("s.scope.attributes")).alias("scope_attributes"),
            F.explode(f"s.{records}").alias("x"),
        )
    )


def _service() -> list[Column]:
    names = {"service_name": "service.name", "service_instance_id": "service.instance.id"}
    return [F.col("resource_attributes")[key].alias(name) for name, key in names.items()]


def flatten_logs(df: DataFrame) -> DataFrame:
    return _flat(df, "resourceLogs", "scopeLogs", "logRecords").select(
        from_nanos(F.col("x.timeUnixNano")).alias("timestamp"),
        from_nanos(F.col("x.observedTimeUnixNano")).alias("observed"),
        *_service(),
        F.col("x.severityNumber").alias("severity_number"),
        F.col("x.severityText").alias("severity_text"),
        text_value(F.col("x.body")).alias("body"),
        F.col("x.eventName").alias("event_name"),
        F.col("x.traceId").alias("trace_id"),
        F.col("x.spanId").alias("span_id"),
        F.col("x.flags").alias("flags"),
        F.col("x.droppedAttributesCount").alias("dropped_attributes"),
        *_OF_SCOPE,
        attribute_map(F.col("x.attributes")).alias("log_attributes"),
    )


def flatten_traces(df: DataFrame) -> DataFrame:
    """One row per span, its events and links as lists in the order they came."""
    start, end = F.col("x.startTimeUnixNano"), F.col("x.endTimeUnixNano")
    events = F.transform(
        "x.events",
        lambda e: F.struct(
            from_nanos(e["timeUnixNano"]).alias("timestamp"),
            e["name"].alias("name"),
            attribute_map(e["attributes"]).alias("attributes"),
            e["droppedAttributesCount"].alias("dropped_attributes"),
        ),
    )
    links = F.transform(
        "x.links",
        lambda k: F.struct(
            k["traceId"].alias("trace_id"),
            k["spanId"].alias("span_id"),
            k["traceState"].alias("trace_state"),
            attribute_map(k["attributes"]).alias("attributes"),
            k["droppedAttributesCount"].alias("dropped_attributes"),
            k["flags"].alias("flags"),
        ),
    )
    return _flat(df, "resourceSpans", "scopeSpans", "spans").select(
        from_nanos(start).alias("timestamp"),
        from_nanos(end).alias("end_time"),
        *_service(),
        F.col("x.traceId").alias("trace_id"),
        F.col("x.spanId").alias("span_id"),
        F.col("x.parentSpanId").alias("parent_span_id"),
        F.col("x.traceState").alias("trace_state"),
        F.col("x.name").alias("span_name"),
        F.col("x.kind").alias("span_kind"),
        (end.cast("bigint") - start.cast("bigint")).alias("duration_nanos"),
        F.col("x.status.code").alias("status_code"),
        F.col("x.status.message").alias("status_message"),
        F.col("x.flags").alias("flags"),
        events.alias("events"),
        links.alias("links"),
        F.col("x.droppedAttributesCount").alias("dropped_attributes"),
        F.col("x.droppedEventsCount").alias("dropped_events"),
        F.col("x.droppedLinksCount").alias("dropped_links"),
        *_OF_SCOPE,
        attribute_map(F.col("x.attributes")).alias("span_attributes"),
    )


def flatten_metrics(df: DataFrame) -> DataFrame:
    """One row per data point of any kind; ``value`` is the number, or the sum of a distribution.

    Buckets, bounds, quantiles and exemplars stay lists, as they came; fields of other kinds are null.
    """
    metrics = _flat(df, "resourceMetrics", "scopeMetrics", "metrics")

    def buckets(side: Column) -> Column:
        counted = F.struct(side["offset"].alias("offset"), side["bucketCounts"].cast("array<bigint>").alias("bucket_counts"))
        return F.when(side.isNotNull(), counted)

    def exemplar(e: Column) -> Column:
        return F.struct(
            from_nanos(e["timeUnixNano"]).alias("timestamp"),
            F.coalesce(e["asDouble"], e["asInt"].cast("double")).alias("value"),
            e["traceId"].alias("trace_id"),
            e["spanId"].alias("span_id"),
            attribute_map(e["filteredAttributes"]).alias("attributes"),
        )

    def points(kind: str) -> Column:
        return F.transform(
            F.coalesce(F.col(f"x.{kind}.dataPoints"), F.array()),
            lambda p: F.struct(
                F.lit(kind).alias("metric_kind"),
                F.col(f"x.{kind}.aggregationTemporality").alias("aggregation_temporality"),
                F.col(f"x.{kind}.isMonotonic").alias("is_monotonic"),
                p.alias("p"),
            ),
        )

    p = F.col("k.p")
    return metrics.select(*_OF_SCOPE, "x", F.explode(F.concat(*[points(kind) for kind in METRIC_KINDS])).alias("k")).select(
        from_nanos(p["timeUnixNano"]).alias("timestamp"),
        from_nanos(p["startTimeUnixNano"]).alias("start_time"),
        *_service(),
        F.col("x.name").alias("metric_name"),
        F.col("x.unit").alias("metric_unit"),
        F.col("x.description").alias("metric_description"),
        "k.metric_kind",
        "k.aggregation_temporality",
        "k.is_monotonic",
        F.coalesce(p["asDouble"], p["asInt"].cast("double"), p["sum"]).alias("value"),
        p["count"].cast("bigint").alias("count"),
        p["min"].alias("min"),
        p["max"].alias("max"),
        p["bucketCounts"].cast("array<bigint>").alias("bucket_counts"),
        p["explicitBounds"].alias("explicit_bounds"),
        p["scale"].alias("scale"),
        p["zeroCount"].cast("bigint").alias("zero_count"),
        p["zeroThreshold"].alias("zero_threshold"),
        buckets(p["positive"]).alias("positive"),
        buckets(p["negative"]).alias("negative"),
        p["quantileValues"].alias("quantiles"),
        F.transform(p["exemplars"], exemplar).alias("exemplars"),
        p["flags"].alias("flags"),
        *_OF_SCOPE,
        attribute_map(p["attributes"]).alias("point_attributes"),
    )


FLATTEN = {"logs": flatten_logs, "traces": flatten_traces, "metrics": flatten_metrics}


def drop_resource(df: DataFrame, attribute: str, value: str, attributes: str = "resource_attributes") -> DataFrame:
    """Drop records of one resource. A record whose condition cannot be decided (no map, no key) is kept."""
    return df.where(~F.coalesce(F.col(attributes)[attribute] == value, F.lit(False)))


def drop_zero_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Drop records stamped with the epoch or before it, or not stamped."""
    return df.where(F.col(ts) > F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


# Fixed value. Record filters per signal: only logs lose the service whose clock is broken.
BROKEN_CLOCK_SERVICE = "currency"
PIPELINES = {
    "logs": [lambda df: drop_resource(df, "service.name", BROKEN_CLOCK_SERVICE)],
    "traces": [],
    "metrics": [],
}


def run_pipeline(df: DataFrame, signal: str, pipelines=None) -> DataFrame:
    """Flatten export documents of one signal and apply its filters."""
    records = FLATTEN[signal](df)
    for step in (pipelines or PIPELINES)[signal]:
        records = step(records)
    return records


# Fields of a proxy access-log line, in line order, name and the pattern of its text.
_BARE, _QUOTED = r"(\S+)", r'"([^"]*)"'
ACCESS_LOG_FIELDS = [
    ("start_time", r"\[([^\]]*)\]"),
    ("method", r'"(\S*)'),
    ("path", r"(\S*)"),
    ("protocol", r'([^"]*)"'),
    ("response_code", _BARE),
    ("response_flags", _BARE),
    ("response_code_details", _BARE),
    ("connection_termination_details", _BARE),
    ("upstream_transport_failure_reason", _QUOTED),
    ("bytes_received", _BARE),
    ("bytes_sent", _BARE),
    ("duration_ms", _BARE),
    ("upstream_service_time_ms", _BARE),
    ("forwarded_for", _QUOTED),
    ("user_agent", _QUOTED),
    ("request_id", _QUOTED),
    ("authority", _QUOTED),
    ("upstream_host", _QUOTED),
    ("upstream_cluster", _BARE),
    ("upstream_local_address", _BARE),
    ("downstream_local_address", _BARE),
    ("downstream_remote_address", _BARE),
    ("requested_server_name", _BARE),
    ("route_name", r"(\S+)\s*$"),
]
ACCESS_LOG_NUMBERS = {"response_code", "bytes_received", "bytes_sent", "duration_ms", "upstream_service_time_ms"}


def parse_access_log(df: DataFrame, line: str) -> DataFrame:
    """Access-log lines to typed columns; ``-`` is null and a line of another form gives nulls throughout.

    The pattern runs once per line: all groups are written side by side and split, instead of one match per column.
    """
    mark = "\u0001"
    pattern = "^" + " ".join(p for _, p in ACCESS_LOG_FIELDS)
    groups = mark.join(f"${i}" for i in range(1, len(ACCESS_LOG_FIELDS) + 1))
    kept = [c for c in df.columns if c != line]
    parts = F.split(F.regexp_replace(line, pattern, groups), mark)
    parted = df.select(*kept, F.when(F.size(parts) == len(ACCESS_LOG_FIELDS), parts).alias("parts"))
    columns = []
    for number, (name, _) in enumerate(ACCESS_LOG_FIELDS):
        value = F.nullif(F.nullif(F.col("parts")[number], F.lit("-")), F.lit(""))
        if name == "start_time":
            value = F.regexp_replace(value, "Z$", "").try_cast("timestamp_ntz")
        elif name in ACCESS_LOG_NUMBERS:
            value = value.try_cast("bigint")
        columns.append(value.alias(name))
    return parted.select(*kept, *columns)


def requests_by(df: DataFrame, *keys: str) -> DataFrame:
    """Requests, bytes and mean duration per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("bytes_sent").alias("bytes_sent"),
        (F.sum("duration_ms").cast("double") / F.count("duration_ms")).alias("mean_duration_ms"),
    )


def flatten_products(df: DataFrame, document: str, schema: str) -> DataFrame:
    """Product documents to one row per product and category, with the price as one decimal number."""
    product = df.select(F.from_json(document, schema).alias("p")).select("p.*")
    price = F.col("priceUsd.units").cast("decimal(20,9)") + F.col("priceUsd.nanos").cast("decimal(20,9)") / F.lit(
        1_000_000_000
    ).cast("decimal(10,0)")
    return product.select(
        "id",
        "name",
        "description",
        F.col("priceUsd.currencyCode").alias("currency"),
        price.cast("decimal(20,9)").alias("price"),
        F.explode_outer("categories").alias("category"),
    )
