"""Batches of telemetry made from the supplied tables, and stream records made from batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..operators.grouping import in_order
from ..packaging import spread
from ..schema import table
from ..sources import codecs, otlp

EVENTS, LINES = 500, 256
KIND_OF = {"n": "gauge", "a": "sum", "r": "histogram"}


def gather(order: str, value: Column) -> Column:
    return F.transform(in_order(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v"))), "o"), lambda x: x["v"])


def attributes(**given: Column) -> Column:
    return F.array(*[values.pair(k, values.text_value(v.cast("string"))) for k, v in given.items()])


def nest(rows: DataFrame, signal: str, item: Column, order: str, resource: Column, scope: Column, resource_by: str, scope_by: str) -> DataFrame:
    """(batch_id, resources) of rows with a batch_id: items under their scope and resource,
    each in the order of its key. Rows are dealt out by batch once."""
    _, top, mid, low = otlp.LEVELS[signal]
    made, holder = {"logs": ("ScopeLogs", "ResourceLogs"), "traces": ("ScopeSpans", "ResourceSpans"), "metrics": ("ScopeMetrics", "ResourceMetrics")}[signal]
    rows = rows.repartition("batch_id").select("batch_id", F.col(resource_by).alias("_r"), F.col(scope_by).alias("_s"), F.col(order).alias("_o"), item.alias("_x"), resource.alias("_res"), scope.alias("_scope"))
    rows = rows.groupBy("batch_id", "_r", "_s").agg(F.first("_res").alias("_res"), F.first("_scope").alias("_scope"), gather("_o", F.col("_x")).alias("_x"))
    rows = rows.withColumn("_x", otlp.build(made, scope=F.col("_scope"), **{low: F.col("_x")}))
    rows = rows.groupBy("batch_id", "_r").agg(F.first("_res").alias("_res"), gather("_s", F.col("_x")).alias("_x"))
    rows = rows.withColumn("_x", otlp.build(holder, resource=F.col("_res"), **{mid: F.col("_x")}))
    return rows.groupBy("batch_id").agg(gather("_r", F.col("_x")).alias("resources"))


def log_batches(spark: SparkSession, d: str) -> DataFrame:
    """Events, ``EVENTS`` to a batch: a resource per user, a scope per type."""
    e = table(spark, d, "events").withColumn("batch_id", F.floor(F.col("event_id") / EVENTS))
    e = e.withColumn("k", F.get_json_object("props", "$.k"))
    record = otlp.build("LogRecord", time_unix_nano=F.col("event_id") + 1, severity_number=F.when(F.col("event_type") == "error", 17).otherwise(9), body=values.text_value(F.col("event_type")), attributes=attributes(k=F.col("k")))
    resource = otlp.build("Resource", attributes=F.array(values.pair("user", values.int_value(F.col("user_id")))))
    return nest(e, "logs", record, "event_id", resource, otlp.build("InstrumentationScope", name=F.col("event_type")), "user_id", "event_type")


def line_batches(spark: SparkSession, d: str) -> DataFrame:
    """Documents as batches: a log record per line of the text."""
    x = table(spark, d, "documents").select(F.col("doc_id").alias("batch_id"), "source", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    record = otlp.build("LogRecord", time_unix_nano=F.col("n") + 1, body=values.text_value(F.col("line")))
    x = x.withColumn("one", F.lit(0))
    return nest(x, "logs", record, "n", otlp.build("Resource", attributes=attributes(source=F.col("source"))), otlp.build("InstrumentationScope"), "one", "one")


def text_batches(spark: SparkSession, d: str) -> DataFrame:
    """Documents as batches of one log record, whose text is an attribute."""
    x = table(spark, d, "documents").select(F.col("doc_id").alias("batch_id"), "text", "source", F.lit(0).alias("one"))
    record = otlp.build("LogRecord", attributes=attributes(text=F.col("text")))
    return nest(x, "logs", record, "one", otlp.build("Resource", attributes=attributes(source=F.col("source"))), otlp.build("InstrumentationScope"), "one", "one")


def span_batches(spark: SparkSession, d: str) -> DataFrame:
    """Lines as spans of their order's trace, ``LINES`` orders to a batch: a resource per
    customer, a scope per priority. Returned lines have an event, later ones link to the first."""
    both = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    both = both.withColumn("batch_id", F.floor(F.col("o_orderkey") / LINES))
    wide = lambda c, n: F.unhex(F.lpad(F.hex(c), n, "0"))
    trace, span = wide(F.col("l_orderkey"), 32), wide(F.col("l_linenumber"), 16)
    event = otlp.build("Event", time_unix_nano=F.col("l_linenumber") * 10, name=F.lit("returned"), attributes=attributes(part=F.col("l_partkey")))
    link = otlp.build("Link", trace_id=trace, span_id=wide(F.lit(1), 16), attributes=attributes(order=F.col("l_orderkey")))
    made = otlp.build(
        "Span", trace_id=trace, span_id=span, parent_span_id=F.when(F.col("l_linenumber") > 1, wide(F.lit(1), 16)).otherwise(F.lit(b"").cast("binary")), name=F.col("o_orderpriority"), kind=F.col("l_linenumber") % 6,
        start_time_unix_nano=F.col("l_linenumber") * 10, end_time_unix_nano=F.col("l_linenumber") * 10 + 5, attributes=attributes(flag=F.col("l_returnflag")),
        events=F.when(F.col("l_returnflag") == "R", F.array(event)).otherwise(F.array()), links=F.when(F.col("l_linenumber") > 1, F.array(link)).otherwise(F.array()), status=otlp.build("Status", code=F.when(F.col("l_returnflag") == "R", 2).otherwise(1)),
    )
    both = both.withColumn("place", F.col("l_orderkey") * 16 + F.col("l_linenumber"))
    return nest(both, "traces", made, "place", otlp.build("Resource", attributes=attributes(cust=F.col("o_custkey"))), otlp.build("InstrumentationScope", name=F.col("o_orderpriority"), version=F.lit("1")), "o_custkey", "o_orderpriority")


def metric_batches(spark: SparkSession, d: str) -> DataFrame:
    """Lines as points, ``LINES`` orders to a batch: a resource per supplier, a metric per flag
    and status whose kind goes by the flag, and a bare shell for each supplier."""
    x = table(spark, d, "lineitem").withColumn("batch_id", F.floor(F.col("l_orderkey") / LINES))
    x = x.withColumns({"flag": F.lower("l_returnflag"), "place": F.col("l_orderkey") * 16 + F.col("l_linenumber"), "one": F.lit(0)})
    x = x.withColumn("name", F.concat("flag", F.lit("_"), F.lower("l_linestatus")))
    at = attributes(part=F.col("l_partkey"))
    exemplar = otlp.build("Exemplar", as_int=F.col("l_linenumber"), filtered_attributes=attributes(status=F.col("l_linestatus")))
    number = {"time_unix_nano": F.col("place"), "attributes": at}
    points = {
        "gauge": otlp.build("NumberDataPoint", as_double=F.col("l_extendedprice"), **number),
        "sum": otlp.build("NumberDataPoint", as_int=F.col("l_quantity").cast("long"), exemplars=F.array(exemplar), **number),
        "histogram": otlp.build("HistogramDataPoint", count=F.col("l_linenumber"), sum=F.col("l_extendedprice"), bucket_counts=F.array(F.lit(1), F.col("l_linenumber") - 1), explicit_bounds=F.array(F.lit(10.0)), **number),
    }
    x = x.select("batch_id", "l_suppkey", "name", "flag", "place", "one", *[F.when(F.col("flag") == f, points[k]).alias(k) for f, k in KIND_OF.items()])
    x = x.repartition("batch_id").groupBy("batch_id", "l_suppkey", "name", "flag", "one").agg(*[gather("place", F.col(k)).alias(k) for k in points])
    data = {
        "gauge": otlp.build("Gauge", data_points=F.col("gauge")),
        "sum": otlp.build("Sum", data_points=F.col("sum"), aggregation_temporality=F.lit(1), is_monotonic=F.lit(True)),
        "histogram": otlp.build("Histogram", data_points=F.col("histogram"), aggregation_temporality=F.lit(2)),
    }
    x = x.withColumn("m", otlp.build("Metric", name=F.col("name"), description=F.lit("lines"), unit=F.lit("1"), **{k: F.when(F.col("flag") == f, data[k]) for f, k in KIND_OF.items()}))
    shells = x.select("batch_id", "l_suppkey", "one").distinct().select("*", F.lit("~").alias("name"), otlp.build("Metric", name=F.lit("idle")).alias("m"))
    both = x.select("batch_id", "l_suppkey", "one", "name", "m").unionByName(shells)
    return nest(both, "metrics", F.col("m"), "name", otlp.build("Resource", attributes=attributes(supp=F.col("l_suppkey"))), otlp.build("InstrumentationScope", name=F.lit("lines")), "l_suppkey", "one")


#: What stands in front of bytes that are no compressed payload, and of text that is no telemetry.
JUNK, NOISE = "not packed: ", "noise: "


def shard_of(user: Column) -> Column:
    return F.format_string("shard-%03d", user % 4)


def records(events: DataFrame, codec: str = "zstd") -> DataFrame:
    """Stream records (shard_id, seq, partition_key, data, error) of events: each is a payload
    of one log record, compressed. Every 13th is no compressed payload, every 17th is one of
    bytes that are no telemetry, so both are found by reading them. ``error`` is what a sink
    says to the record: transient to errors, permanent to signups."""
    record = otlp.build("LogRecord", time_unix_nano=F.col("event_id") + 1, body=values.text_value(F.col("event_type")), attributes=attributes(props=F.col("props")))
    scope = otlp.build("ScopeLogs", scope=otlp.build("InstrumentationScope"), log_records=F.array(record))
    resources = F.array(otlp.build("ResourceLogs", resource=otlp.build("Resource", attributes=attributes(user=F.col("user_id"))), scope_logs=F.array(scope)))
    text = F.when(F.col("event_id") % 17 == 0, F.concat(F.lit(NOISE), "props")).otherwise(otlp.to_otlp_json("logs", resources))
    rows = events.withColumn("_text", text)
    data = F.when(F.col("event_id") % 13 == 0, F.encode(F.concat(F.lit(JUNK), "props"), "utf-8")).otherwise(codecs.compress(F.encode("_text", "utf-8"), codec))
    shard = shard_of(F.col("user_id"))
    error = F.when(F.col("event_type") == "error", "transient").when(F.col("event_type") == "signup", "permanent")
    return rows.select(shard.alias("shard_id"), F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("partition_key"), data.alias("data"), error.alias("error"))


def sink_verdict(rows: DataFrame) -> Column:
    """A sink that rejects by what it reads: error bodies for now, signups for good."""
    body = F.try_element_at(F.try_element_at(F.try_element_at(F.col("resources"), F.lit(1))["scope_logs"], F.lit(1))["log_records"], F.lit(1))["body"]["string_value"]
    return F.when(body == "error", "transient").when(body == "signup", "permanent")


def event_records(spark: SparkSession, d: str) -> DataFrame:
    return records(spread(table(spark, d, "events")))
