import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from telestream.config import REJECT, SPLIT, TRUNCATE, KeySource, WriterConfig
from telestream.functions import values
from telestream.operators import exporting, grouping, oversize, sending
from telestream.packaging import ship
from telestream.sources import otlp

BASE = WriterConfig(stream_name="s", region="r", encoding="otlp_json", strategy="tag_hash", tags=("svc",))


def attrs(**given):
    return F.array(*[values.pair(k, values.text_value(F.lit(v) if isinstance(v, str) else v)) for k, v in given.items()])


def logs(spark, resources, items, size=5, batches=2):
    record = lambda i: otlp.build("LogRecord", time_unix_nano=i, body=values.text_value(F.lit("b")), attributes=attrs(k=F.repeat(F.lit("é"), size)))
    scope = lambda s: otlp.build("ScopeLogs", scope=otlp.build("InstrumentationScope", name=F.concat(F.lit("s"), s)), log_records=F.transform(F.sequence(F.lit(1), F.lit(items)), record))
    resource = lambda r: otlp.build("ResourceLogs", resource=otlp.build("Resource", attributes=attrs(svc="A")), scope_logs=F.transform(F.sequence(F.lit(1), F.lit(2)), scope))
    return spark.range(batches).select(F.col("id").alias("batch_id"), F.transform(F.sequence(F.lit(1), F.lit(resources)), resource).alias("resources"))


@pytest.mark.parametrize("encoding, codec, limit", [("otlp_json", "none", 400), ("otlp_proto", "none", 300)])
def test_splitting_keeps_every_item_within_the_limit(spark, encoding, codec, limit):
    ship(spark)
    cfg = dataclasses.replace(BASE, encoding=encoding, compression=codec, max_record_size=limit, max_attempts=16)
    x = exporting.export_logs(logs(spark, 3, 4), cfg)
    got = x.records.collect()
    assert x.drops.count() == 0 and sum(r["items"] for r in got) == 48 and all(len(r["data"]) <= limit for r in got) and len(got) > 2
    assert len({r["partition_key"] for r in got}) == 1 and x.requests.agg(F.sum("n")).first()[0] == len(got)
    if encoding == "otlp_json":
        back = x.records.select(F.explode(otlp.decoder("logs", encoding)(F.col("data"))).alias("r")).select(F.explode("r.scope_logs").alias("s"))
        assert {r[0] for r in back.select("s.scope.name").distinct().collect()} == {"s1", "s2"} and back.filter(F.size("s.log_records") == 0).count() == 0


def test_reasons_stay_apart(spark):
    ship(spark)
    reason = lambda cfg, df: {(r["reason"]): r["n"] for r in exporting.export_logs(df, cfg).drops.filter("batch_id = 0").collect()}
    tiny = dataclasses.replace(BASE, max_record_size=16)
    assert reason(dataclasses.replace(tiny, max_attempts=1), logs(spark, 2, 2)) == {"max_attempts": 8}
    assert reason(dataclasses.replace(tiny, max_attempts=9), logs(spark, 1, 2)) == {"irreducible": 4}
    assert reason(dataclasses.replace(tiny, policies=(TRUNCATE, REJECT)), logs(spark, 1, 1)) == {"reject_policy": 2}
    assert reason(dataclasses.replace(tiny, policies=(TRUNCATE,)), logs(spark, 1, 1)) == {"chain_exhausted": 2}


def test_what_cannot_be_encoded_or_compressed_is_dropped(spark, monkeypatch):
    ship(spark)
    cfg = dataclasses.replace(BASE, policies=(SPLIT,))
    with monkeypatch.context() as m:
        m.setattr(exporting.otlp, "encoder", lambda s, e: lambda c: F.lit(None).cast("binary"))
        assert [(r["reason"], r["n"]) for r in exporting.export_logs(logs(spark, 1, 1, batches=1), cfg).drops.collect()] == [("marshal_error", 2)]
    with monkeypatch.context() as m:
        m.setattr(exporting.codecs, "compressor", lambda c: lambda d: F.lit(None).cast("binary"))
        assert [(r["reason"], r["n"]) for r in exporting.export_logs(logs(spark, 1, 1, batches=1), cfg).drops.collect()] == [("compress_error", 2)]


def test_truncation_ships_what_then_fits(spark):
    ship(spark)
    cfg = dataclasses.replace(BASE, max_record_size=600, policies=(TRUNCATE, SPLIT), max_attribute_value_bytes=9)
    df = logs(spark, 1, 1, size=2000)
    x = exporting.export_logs(df, cfg)
    assert x.records.count() == 2 and x.drops.count() == 0 and {r["n"] for r in x.clamped.collect()} == {2}
    _, n = exporting.truncate("logs", F.col("resources"), 9)
    assert df.select(n).first()[0] == 2
    figures = {(r["name"], r["reason"]): r["n"] for r in exporting.writer_figures(x).collect()}
    assert figures == {("attributes_truncated", ""): 4, ("put_requests", ""): 2, ("put_records", ""): 2, ("put_bytes", ""): x.records.agg(F.sum(F.length("data"))).first()[0]}


def test_truncation_reaches_every_level(spark):
    long = F.lit("x" * 20)
    own, other = attrs(a=long), values.text_value(F.lit(None).cast("string")).withField("bytes_value", F.encode(long, "utf-8"))
    span = otlp.build("Span", attributes=F.concat(own, F.array(values.pair("b", other))), events=F.array(otlp.build("Event", attributes=own)), links=F.array(otlp.build("Link", attributes=own)))
    scope = otlp.build("ScopeSpans", scope=otlp.build("InstrumentationScope", attributes=own), spans=F.array(span))
    traces = F.array(otlp.build("ResourceSpans", resource=otlp.build("Resource", attributes=own), scope_spans=F.array(scope)))
    exemplar = F.array(otlp.build("Exemplar", filtered_attributes=own))
    metrics = [otlp.build("Metric", gauge=otlp.build("Gauge", data_points=F.array(otlp.build("NumberDataPoint", attributes=own, exemplars=exemplar)))), otlp.build("Metric", summary=otlp.build("Summary", data_points=F.array(otlp.build("SummaryDataPoint", attributes=own)))), otlp.build("Metric", histogram=otlp.build("Histogram", data_points=F.array(otlp.build("HistogramDataPoint", attributes=own, exemplars=exemplar)))), otlp.build("Metric", name=F.lit("bare"))]
    points = F.array(otlp.build("ResourceMetrics", scope_metrics=F.array(otlp.build("ScopeMetrics", metrics=F.array(*metrics)))))
    for signal, r, want in (("traces", traces, 5), ("metrics", points, 5)):
        df = spark.range(1).select(r.alias("resources"))
        made, n = exporting.truncate(signal, F.col("resources"), 8)
        row = df.select(n.alias("n"), F.to_json(F.struct(made.alias("m"))).alias("t")).first()
        assert row["n"] == want and "x" * 9 not in row["t"] and row["t"].count("x" * 8) == want
        back = df.select(made.alias("m"))
        assert back.select(exporting.truncate(signal, F.col("m"), 8)[1]).first()[0] == 0


def test_one_metric_is_halved_at_its_points(spark):
    point = lambda i: otlp.build("NumberDataPoint", as_int=i, attributes=F.array(values.pair("i", values.int_value(i))))
    metric = otlp.build("Metric", name=F.lit("m"), description=F.lit("d"), sum=otlp.build("Sum", data_points=F.transform(F.sequence(F.lit(1), F.lit(9)), point), aggregation_temporality=F.lit(1), is_monotonic=F.lit(True)))
    own = otlp.build("ResourceMetrics", resource=otlp.build("Resource", attributes=attrs(svc="A")), scope_metrics=F.array(otlp.build("ScopeMetrics", metrics=F.array(metric))))
    df = spark.range(1).select(F.col("id").alias("batch_id"), F.array(own).alias("resources"))
    can, left, right = exporting.halves("metrics", F.col("resources"))
    r = df.select(can.alias("c"), exporting.item_count("metrics", left).alias("l"), exporting.item_count("metrics", right).alias("r")).first()
    assert tuple(r) == (True, 4, 5)
    ship(spark)
    x = exporting.export_metrics(df, dataclasses.replace(BASE, max_record_size=420))
    got = x.records.select("items", F.col("data").cast("string").alias("t")).collect()
    assert sum(r["items"] for r in got) == 9 and len(got) > 1
    for r in got:  # every piece has the whole shell
        m = json.loads(r["t"])["resourceMetrics"][0]["scopeMetrics"][0]["metrics"][0]
        assert (m["name"], m["description"], m["sum"]["isMonotonic"], m["sum"]["aggregationTemporality"]) == ("m", "d", True, 1)


def test_groups_of_two_batches_stay_apart(spark):
    record = lambda t, n: otlp.build("LogRecord", time_unix_nano=F.lit(n), attributes=attrs(t=t))
    scope = otlp.build("ScopeLogs", log_records=F.array(record("b", 1), record("a", 2), record("b", 3)))
    own = lambda svc: otlp.build("ResourceLogs", resource=otlp.build("Resource", attributes=F.array(values.pair("svc", values.text_value(svc)))), scope_logs=F.array(scope, otlp.build("ScopeLogs")))
    df = spark.range(2).select(F.col("id").alias("batch_id"), F.array(own(F.concat(F.lit("s"), "id")), own(F.lit("same"))).alias("resources"))
    got = grouping.group_batches(df, "logs", (KeySource("datapoint", "t", promote="svc2"),)).orderBy("batch_id", "first").collect()
    assert [(r["batch_id"], r["tag"]) for r in got] == [(0, "b"), (0, "a"), (1, "b"), (1, "a")]
    for r in got:
        services = [x["resource"]["attributes"][0]["value"]["string_value"] for x in r["resources"]]
        assert services == [f"s{r['batch_id']}", "same"]
        times = [[y["time_unix_nano"] for y in x["scope_logs"][0]["log_records"]] for x in r["resources"]]
        assert times == ([[1, 3]] * 2 if r["tag"] == "b" else [[2]] * 2) and all(len(x["scope_logs"]) == 1 for x in r["resources"])
        assert {a["key"]: a["value"]["string_value"] for a in r["resources"][0]["scope_logs"][0]["log_records"][0]["attributes"]} == {"t": r["tag"], "svc2": r["tag"]}
    by = grouping.group_batches(df, "logs", (KeySource(name="svc"),)).orderBy("batch_id", "first").collect()
    assert [(r["batch_id"], r["tag"], len(r["resources"])) for r in by] == [(0, "s0", 1), (0, "same", 1), (1, "s1", 1), (1, "same", 1)]
    assert grouping.group_batches(df, "logs", None).count() == 2


def test_random_keys_are_one_per_group(spark):
    ship(spark)
    cfg = dataclasses.replace(BASE, strategy="random", tags=(), max_record_size=400, max_attempts=16)
    x = exporting.export_logs(logs(spark, 3, 4), cfg).records
    assert {r["count"] for r in x.groupBy("batch_id").count().collect()} != {1} and x.select("batch_id", "partition_key").distinct().count() == 2


def service():
    class Service:
        """Takes entries, fails some for now and some for good, and whole calls when told to."""

        def __init__(self):
            self.calls = 0

        def put_records(self, StreamName, Records):
            self.calls += 1
            if any(r["Data"] == b"down" for r in Records):
                e = RuntimeError("no")
                e.response = {"Error": {"Code": "ResourceNotFoundException"}}
                raise e
            code = lambda d: "AccessDenied" if d == b"bad" else "InternalFailure" if d == b"never" or d == b"later" and self.calls < 3 else None
            return {"Records": [{"ErrorCode": code(r["Data"])} for r in Records]}

    return Service


def test_requests_are_sent_and_partial_failures_repeated(spark):
    ship(spark)
    rows = [(1, 0, "", "k", b"a"), (1, 1, "", "k", b"later"), (1, 2, "", "k", b"bad"), (1, 3, "", "k", b"x"), (2, 0, "", "k", b"never"), (3, 0, "", "k", b"down")]
    df = spark.createDataFrame([(*r[:4], bytearray(r[4])) for r in rows], "batch_id long, first long, path string, partition_key string, data binary")
    got = sorted(tuple(r) for r in sending.send(df, service(), "s", max_records=3, wait=lambda s: None).collect())
    assert got == [(1, 0, 3, 2, 1, 0, None), (1, 1, 1, 1, 0, 0, None), (2, 0, 5, 0, 0, 1, None), (3, 0, 1, 0, 0, 0, "permanent")]


def test_lines_are_posted_and_refusals_are_errors(spark):
    import http.server
    import threading

    from telestream.sources import generate

    got = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            got.append(self.rfile.read(int(self.headers["Content-Length"])).decode())
            self.send_response(204 if self.path == "/write" else 500)
            self.end_headers()

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        at = f"http://127.0.0.1:{server.server_port}"
        lines = generate.line_protocol(generate.line_points(spark, total=450))
        assert sorted(r["status"] for r in sending.post_lines(lines, f"{at}/write").collect()) == [204] * 3
        assert sorted(x.count("\n") for x in got) == [50, 200, 200]
        with pytest.raises(Exception, match="500"):
            sending.post_lines(lines, f"{at}/no").collect()
    finally:
        server.shutdown()


def test_array_halves(spark):
    a, b = oversize.split_array(F.array(*map(F.lit, (1, 2, 3))))
    assert tuple(spark.range(1).select(a.alias("a"), b.alias("b")).first()) == ([1], [2, 3])
