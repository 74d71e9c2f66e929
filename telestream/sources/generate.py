"""Deterministic datasets from ``spark.range``: line protocol, metrics and traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from . import otlp

#: Vocabularies of the generated data (fixed values): line protocol, then datasets.
MEASUREMENTS = ["http_requests", "http_latency", "system_cpu"]
REGIONS = ["us-east", "us-west", "eu-west", "eu-central", "ap-south"]
HOSTS = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel"]
CLOUD_REGIONS = ["us-east-1", "us-west-2", "eu-west-1", "ap-southeast-2"]
SERVICES = ["checkout", "search", "catalog", "payments", "auth", "shipping"]
ENVIRONMENTS = ["prod", "stage", "dev"]
VERSIONS = ["v1.0.0", "v1.1.3", "v2.0.0", "v2.1.0"]
ENDPOINTS = ["/v1/cart", "/v1/items", "/v1/users", "/v1/search", "/healthz", "/metrics"]
METHODS = ["GET", "POST", "PUT", "DELETE"]
STATES = ["user", "system", "idle"]
EVENT_KINDS = ["created", "updated", "deleted", "queried"]
TICK_NS = 1_000_000


def pick(values: list[str], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (i % len(values)).cast("int") + 1)


def hashed(i: Column, salt: str) -> Column:
    """A seeded draw for row i."""
    return F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(1 << 30))


def line_points(spark: SparkSession, total: int = 2000, hosts: int = 8, regions: int = 3, instances: int = 4, base_ns: int = 0) -> DataFrame:
    if min(total, hosts, regions, instances) <= 0:
        raise ValueError("total, hosts, regions and instances must be positive")
    i = F.col("i")
    df = spark.range(total).withColumnRenamed("id", "i")
    region = pick(REGIONS, F.floor(i / hosts) % regions)
    return df.select("i", pick(MEASUREMENTS, i).alias("measurement"), F.concat(F.lit("h"), i % hosts).alias("host"), region.alias("region"), F.concat(F.lit("inst"), i % instances).alias("instance"), ((i % 100) / 100.0).alias("value"), (i * TICK_NS + base_ns).alias("ts_ns"))


def line_protocol(points: DataFrame, batch: int = 200) -> DataFrame:
    """(batch, value): the text of each request."""
    line = F.format_string("%s,host=%s,region=%s,instance=%s value=%.2f %d\n", "measurement", "host", "region", "instance", "value", "ts_ns")
    rows = points.select(F.floor(F.col("i") / batch).alias("batch"), F.struct("i", line.alias("line")).alias("x"))
    return rows.groupBy("batch").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["line"]), "").alias("value"))


def read_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(measurement, tags, value, ts_ns) of line protocol with one field ``value``; other
    lines are skipped."""
    line = F.col(column)
    part = lambda i: F.regexp_extract(line, r"^([^, ]+)((?:,[^ ]*)?) value=([-+\d.eE]+) (\d+)$", i)
    rows = lines.select(part(1).alias("measurement"), F.str_to_map(F.ltrim(part(2), F.lit(",")), F.lit(","), F.lit("=")).alias("attrs"), part(2).alias("tags"), part(3).try_cast("double").alias("value"), part(4).try_cast("long").alias("ts_ns"))
    return rows.filter("measurement <> ''")


def _attributes(**given: Column) -> Column:
    """Attributes by name (two low lines stand for a point); all are strings but codes."""
    return F.array(*[values.pair(k.replace("__", "."), values.int_value(v) if k.endswith("_code") else values.text_value(v)) for k, v in given.items()])


def high_cardinality(spark: SparkSession, n: int) -> DataFrame:
    """Histogram points, each with attributes of its own."""
    i = F.col("id")
    request = F.format_string("req-%010d-%04x", i, hashed(i, "request") % 65536)
    at = _attributes(request__id=request, user__id=F.format_string("u-%08x", hashed(i, "user")), http__route=pick(ENDPOINTS, hashed(i, "route")), http__method=pick(METHODS, hashed(i, "method")), http__status_code=200 + i % 5 * 100, host__name=pick(HOSTS, hashed(i, "host")))
    point = otlp.build("HistogramDataPoint", attributes=at, start_time_unix_nano=i * TICK_NS, time_unix_nano=i * TICK_NS + TICK_NS // 2, count=1 + i % 17, sum=i * 1.5)
    return spark.range(n).select(i.alias("l"), point.alias("point"))


def high_frequency(spark: SparkSession, n: int) -> DataFrame:
    """Gauge points of few series."""
    i = F.col("id")
    at = _attributes(host__name=pick(HOSTS, i), cloud__region=pick(CLOUD_REGIONS, i), state=pick(STATES, i))
    point = otlp.build("NumberDataPoint", attributes=at, time_unix_nano=i * (TICK_NS // 10), as_double=hashed(i, "value") % 1000 / 1000.0)
    return spark.range(n).select(i.alias("l"), point.alias("point"))


def balanced(spark: SparkSession, n: int) -> DataFrame:
    """Sum points of some hundred series."""
    i = F.col("id")
    at = _attributes(host__name=pick(HOSTS, i), endpoint=pick(ENDPOINTS, i), event__kind=pick(EVENT_KINDS, i), tenant=F.format_string("t-%03d", i % 50))
    point = otlp.build("NumberDataPoint", attributes=at, time_unix_nano=i * (TICK_NS // 2), as_int=1 + hashed(i, "value") % 1000)
    return spark.range(n).select(i.alias("l"), point.alias("point"))


#: Of each profile: its points, the metric they stand in, and its unit.
PROFILES = {"metrics-high-cardinality": (high_cardinality, "histogram", "http.server.request.duration", "ms"), "metrics-high-frequency": (high_frequency, "gauge", "system.cpu.utilization", "1"), "metrics-balanced": (balanced, "sum", "app.events.count", "")}


def metrics(spark: SparkSession, profile: str, n: int) -> DataFrame:
    """(l, point) of a profile."""
    if n <= 0:
        raise ValueError(f"invalid batch size {n}")
    if profile not in PROFILES:
        raise ValueError(f"unknown metrics profile {profile!r}")
    return PROFILES[profile][0](spark, n)


def traces(spark: SparkSession, n: int) -> DataFrame:
    """(k, span) with random ids."""
    if n <= 0:
        raise ValueError(f"invalid batch size {n}")
    i = F.col("id")
    digits = lambda salt, k: F.unhex(F.substring(F.sha2(F.concat(F.lit(salt), i.cast("string")), 256), 1, k))
    at = _attributes(http__route=pick(ENDPOINTS, hashed(i, "route")), http__status_code=200 + i % 5 * 100, net__peer__name=pick(HOSTS, hashed(i, "host")))
    name = F.concat_ws(" ", pick(METHODS[:3], hashed(i, "method")), pick(ENDPOINTS, hashed(i, "endpoint")))
    span = otlp.build("Span", trace_id=digits("trace", 32), span_id=digits("span", 16), name=name, start_time_unix_nano=i * TICK_NS, end_time_unix_nano=i * TICK_NS + TICK_NS // 2, attributes=at)
    return spark.range(n).select(i.alias("k"), span.alias("span"))


def _resource(seed: str, *names: str) -> Column:
    words = {"service.name": SERVICES, "deployment.environment": ENVIRONMENTS, "service.version": VERSIONS}
    return otlp.build("Resource", attributes=F.array(*[values.pair(k, values.text_value(pick(words[k], hashed(F.lit(0), seed + k)))) for k in names]))


def batches(spark: SparkSession, profile: str, n: int, size: int) -> DataFrame:
    """(batch_id, resources): a profile's points, or typical traces, in batches of ``size``."""
    if profile == "traces-typical":
        rows = traces(spark, n).groupBy(F.floor(F.col("k") / size).alias("batch_id")).agg(F.sort_array(F.collect_list(F.struct("k", F.col("span").alias("x")))).alias("x"))
        scope = otlp.build("ScopeSpans", scope=otlp.build("InstrumentationScope", name=F.lit("perf.tracer")), spans=F.col("x.x"))
        own = otlp.build("ResourceSpans", resource=_resource(profile, "service.name", "deployment.environment", "service.version"), scope_spans=F.array(scope))
        return rows.select("batch_id", F.array(own).alias("resources"))
    _, kind, name, unit = PROFILES[profile]
    rows = metrics(spark, profile, n).groupBy(F.floor(F.col("l") / size).alias("batch_id")).agg(F.sort_array(F.collect_list(F.struct("l", F.col("point").alias("x")))).alias("x"))
    data = otlp.build({"gauge": "Gauge", "sum": "Sum", "histogram": "Histogram"}[kind], data_points=F.col("x.x"))
    metric = otlp.build("Metric", name=F.lit(name), unit=F.lit(unit), **{kind: data})
    scope = otlp.build("ScopeMetrics", scope=otlp.build("InstrumentationScope", name=F.lit(f"perf.{profile.removeprefix('metrics-')}")), metrics=F.array(metric))
    keys = {"metrics-high-cardinality": 2, "metrics-high-frequency": 1, "metrics-balanced": 3}[profile]
    own = otlp.build("ResourceMetrics", resource=_resource(profile, *("service.name", "deployment.environment", "service.version")[:keys]), scope_metrics=F.array(scope))
    return rows.select("batch_id", F.array(own).alias("resources"))
