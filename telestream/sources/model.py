"""The OTLP data model: messages, field numbers and kinds, and the Spark types they become.

A column of resources has the type ``ddl(signal)``, which names fields as the protocol
does. 64-bit integers are longs, ids and other bytes are binary. A value (AnyValue) is a
struct with a field per kind, of which one is set at most; lists and maps inside a value,
which may nest without end, are the protocol's JSON as text.
"""

from __future__ import annotations

from functools import cache

#: Messages as name -> {field: (number, kind)} (fixed by the protocol). A kind is a scalar,
#: or a message; ``*`` marks repeated fields, ``?`` scalars that may be absent, ``|`` members
#: of a choice of one.
MESSAGES: dict[str, dict[str, tuple[int, str]]] = {
    "AnyValue": {"string_value": (1, "|string"), "bool_value": (2, "|bool"), "int_value": (3, "|int64"), "double_value": (4, "|double"), "array_value": (5, "|ArrayValue"), "kvlist_value": (6, "|KeyValueList"), "bytes_value": (7, "|bytes")},
    "ArrayValue": {"values": (1, "*AnyValue")},
    "KeyValueList": {"values": (1, "*KeyValue")},
    "KeyValue": {"key": (1, "string"), "value": (2, "AnyValue")},
    "Resource": {"attributes": (1, "*KeyValue"), "dropped_attributes_count": (2, "uint32")},
    "InstrumentationScope": {"name": (1, "string"), "version": (2, "string"), "attributes": (3, "*KeyValue"), "dropped_attributes_count": (4, "uint32")},
    "ResourceLogs": {"resource": (1, "Resource"), "scope_logs": (2, "*ScopeLogs"), "schema_url": (3, "string")},
    "ScopeLogs": {"scope": (1, "InstrumentationScope"), "log_records": (2, "*LogRecord"), "schema_url": (3, "string")},
    "LogRecord": {
        "time_unix_nano": (1, "fixed64"), "observed_time_unix_nano": (11, "fixed64"), "severity_number": (2, "enum"), "severity_text": (3, "string"), "body": (5, "AnyValue"), "attributes": (6, "*KeyValue"),
        "dropped_attributes_count": (7, "uint32"), "flags": (8, "fixed32"), "trace_id": (9, "bytes"), "span_id": (10, "bytes"), "event_name": (12, "string"),
    },
    "ResourceSpans": {"resource": (1, "Resource"), "scope_spans": (2, "*ScopeSpans"), "schema_url": (3, "string")},
    "ScopeSpans": {"scope": (1, "InstrumentationScope"), "spans": (2, "*Span"), "schema_url": (3, "string")},
    "Span": {
        "trace_id": (1, "bytes"), "span_id": (2, "bytes"), "trace_state": (3, "string"), "parent_span_id": (4, "bytes"), "flags": (16, "fixed32"), "name": (5, "string"), "kind": (6, "enum"),
        "start_time_unix_nano": (7, "fixed64"), "end_time_unix_nano": (8, "fixed64"), "attributes": (9, "*KeyValue"), "dropped_attributes_count": (10, "uint32"), "events": (11, "*Event"), "dropped_events_count": (12, "uint32"),
        "links": (13, "*Link"), "dropped_links_count": (14, "uint32"), "status": (15, "Status"),
    },
    "Event": {"time_unix_nano": (1, "fixed64"), "name": (2, "string"), "attributes": (3, "*KeyValue"), "dropped_attributes_count": (4, "uint32")},
    "Link": {"trace_id": (1, "bytes"), "span_id": (2, "bytes"), "trace_state": (3, "string"), "attributes": (4, "*KeyValue"), "dropped_attributes_count": (5, "uint32"), "flags": (6, "fixed32")},
    "Status": {"message": (2, "string"), "code": (3, "enum")},
    "ResourceMetrics": {"resource": (1, "Resource"), "scope_metrics": (2, "*ScopeMetrics"), "schema_url": (3, "string")},
    "ScopeMetrics": {"scope": (1, "InstrumentationScope"), "metrics": (2, "*Metric"), "schema_url": (3, "string")},
    "Metric": {
        "name": (1, "string"), "description": (2, "string"), "unit": (3, "string"), "gauge": (5, "|Gauge"), "sum": (7, "|Sum"), "histogram": (9, "|Histogram"),
        "exponential_histogram": (10, "|ExponentialHistogram"), "summary": (11, "|Summary"), "metadata": (12, "*KeyValue"),
    },
    "Gauge": {"data_points": (1, "*NumberDataPoint")},
    "Sum": {"data_points": (1, "*NumberDataPoint"), "aggregation_temporality": (2, "enum"), "is_monotonic": (3, "bool")},
    "Histogram": {"data_points": (1, "*HistogramDataPoint"), "aggregation_temporality": (2, "enum")},
    "ExponentialHistogram": {"data_points": (1, "*ExponentialHistogramDataPoint"), "aggregation_temporality": (2, "enum")},
    "Summary": {"data_points": (1, "*SummaryDataPoint")},
    "NumberDataPoint": {"attributes": (7, "*KeyValue"), "start_time_unix_nano": (2, "fixed64"), "time_unix_nano": (3, "fixed64"), "as_double": (4, "|double"), "as_int": (6, "|sfixed64"), "exemplars": (5, "*Exemplar"), "flags": (8, "uint32")},
    "HistogramDataPoint": {
        "attributes": (9, "*KeyValue"), "start_time_unix_nano": (2, "fixed64"), "time_unix_nano": (3, "fixed64"), "count": (4, "fixed64"), "sum": (5, "?double"), "bucket_counts": (6, "*fixed64"),
        "explicit_bounds": (7, "*double"), "exemplars": (8, "*Exemplar"), "flags": (10, "uint32"), "min": (11, "?double"), "max": (12, "?double"),
    },
    "ExponentialHistogramDataPoint": {
        "attributes": (1, "*KeyValue"), "start_time_unix_nano": (2, "fixed64"), "time_unix_nano": (3, "fixed64"), "count": (4, "fixed64"), "sum": (5, "?double"), "scale": (6, "sint32"), "zero_count": (7, "fixed64"),
        "positive": (8, "Buckets"), "negative": (9, "Buckets"), "flags": (10, "uint32"), "exemplars": (11, "*Exemplar"), "min": (12, "?double"), "max": (13, "?double"), "zero_threshold": (14, "double"),
    },
    "Buckets": {"offset": (1, "sint32"), "bucket_counts": (2, "*uint64")},
    "SummaryDataPoint": {"attributes": (7, "*KeyValue"), "start_time_unix_nano": (2, "fixed64"), "time_unix_nano": (3, "fixed64"), "count": (4, "fixed64"), "sum": (5, "double"), "quantile_values": (6, "*ValueAtQuantile"), "flags": (8, "uint32")},
    "ValueAtQuantile": {"quantile": (1, "double"), "value": (2, "double")},
    "Exemplar": {"filtered_attributes": (7, "*KeyValue"), "time_unix_nano": (2, "fixed64"), "as_double": (3, "|double"), "as_int": (6, "|sfixed64"), "span_id": (4, "bytes"), "trace_id": (5, "bytes")},
    "LogsRequest": {"resource_logs": (1, "*ResourceLogs")},
    "TracesRequest": {"resource_spans": (1, "*ResourceSpans")},
    "MetricsRequest": {"resource_metrics": (1, "*ResourceMetrics")},
}
#: Spark types of scalars.
SCALARS = {"string": "string", "bool": "boolean", "int64": "bigint", "uint64": "bigint", "fixed64": "bigint", "sfixed64": "bigint", "double": "double", "bytes": "binary", "uint32": "bigint", "fixed32": "bigint", "sint32": "int", "enum": "int"}
#: What a scalar that is not written stands for.
DEFAULTS = {"string": "", "bool": False, "double": 0.0, "bytes": b""} | {k: 0 for k in ("int64", "uint64", "fixed64", "sfixed64", "uint32", "fixed32", "sint32", "enum")}
#: Values that hold values; they are JSON text in Spark.
NESTED = ("ArrayValue", "KeyValueList")
#: Of each signal: the request, its resources, their scopes, and the scopes' items.
LEVELS = {"logs": ("LogsRequest", "resource_logs", "scope_logs", "log_records"), "traces": ("TracesRequest", "resource_spans", "scope_spans", "spans"), "metrics": ("MetricsRequest", "resource_metrics", "scope_metrics", "metrics")}
#: The kinds of a metric, and those that carry temporality.
METRIC_KINDS = ("gauge", "sum", "histogram", "exponential_histogram", "summary")
TEMPORAL = ("sum", "histogram", "exponential_histogram")


def parts(kind: str) -> tuple[bool, str, str]:
    """(repeated, '?' or '|' or '', scalar or message)."""
    many = kind[0] == "*"
    mark = kind[0] if kind[0] in "?|" else ""
    return many, mark, kind.lstrip("*?|")


@cache
def struct_ddl(message: str) -> str:
    return f"struct<{', '.join(f'{f}: {field_ddl(k)}' for f, (_, k) in MESSAGES[message].items())}>"


def field_ddl(kind: str) -> str:
    many, _, inner = parts(kind)
    one = SCALARS.get(inner) or ("string" if inner in NESTED else struct_ddl(inner))
    return f"array<{one}>" if many else one


def ddl(signal: str) -> str:
    """The type of a signal's resources."""
    request, resources, _, _ = LEVELS[signal]
    return field_ddl(MESSAGES[request][resources][1])


def camel(field: str) -> str:
    head, *rest = field.split("_")
    return head + "".join(x.capitalize() for x in rest)
