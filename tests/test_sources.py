import base64
import functools
import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telestream.config import CODECS, ENCODINGS, ConfigError
from telestream.operators.delivery import audit
from telestream.packaging import ship
from telestream.functions import values
from telestream.sources import codecs, generate, model, otlp, shards, wire
from telestream.streaming import pipeline



def some(message, rng, depth=0):
    """A message with every field at its default, absent, or at some value."""
    fields = model.MESSAGES[message]
    if message == "AnyValue":
        k = rng.choice([f for f in fields if depth < 6 or f not in ("array_value", "kvlist_value")])
        return {k: {"string_value": 'é"x\n', "bool_value": True, "int_value": -(2**60), "double_value": 1.25e-9, "bytes_value": b"\x00\xff", "array_value": '{"values":[{"intValue":"7"},{"arrayValue":{"values":[{"stringValue":"a"}]}}]}', "kvlist_value": '{"values":[{"key":"q","value":{"doubleValue":1.5}}]}'}[k]}
    choices = [f for f, (_, k) in fields.items() if k[0] == "|"]
    pick, out = rng.choice([*choices, None]) if choices else None, {}
    for f, (_, kind) in fields.items():
        many, mark, inner = model.parts(kind)
        if mark == "|" and f != pick or mark == "?" and rng.random() < 0.5 or inner in model.MESSAGES and not many and not mark and rng.random() < 0.2:
            out[f] = None
            continue
        one = lambda inner=inner: some(inner, rng, depth + 1) if inner in model.MESSAGES else {"string": rng.choice(["", "s"]), "bool": rng.random() < 0.5, "double": rng.choice([0.0, -1.5]), "bytes": rng.choice([b"", b"\x01\xab"]), "enum": rng.randrange(3)}.get(inner, rng.choice([0, 5, 2**31 - 1]) if inner in ("sint32", "uint32", "fixed32") else rng.choice([0, 7, 2**62]))
        out[f] = [one() for _ in range(rng.randrange(3))] if many else one()
    return out


def batches_of(signal, n, seed=1):
    request, top, _, _ = model.LEVELS[signal]
    rng = random.Random(seed)
    return [[some(model.MESSAGES[request][top][1][1:], rng) for _ in range(2)] for _ in range(n)]


@pytest.mark.parametrize("signal", ["logs", "traces", "metrics"])
def test_bytes_equal_those_of_the_protobuf_runtime(signal):
    """The plain writer against the runtime's classes, both ways, over the whole model."""
    request, top, _, _ = model.LEVELS[signal]
    made = wire.classes()
    if made is None:
        pytest.skip("the protobuf runtime is not installed")
    strip = lambda x: [strip(v) for v in x] if isinstance(x, list) else {k: strip(v) for k, v in x.items() if v is not None} if isinstance(x, dict) else x
    for rows in batches_of(signal, 150):
        data = wire.encode_message(request, {top: rows})
        assert wire.encode(signal, rows) == data
        assert made[request].FromString(data).SerializeToString(deterministic=True) == data
        assert strip(wire.decode(signal, data)) == strip(wire.decode_message(request, data)[top])
        assert wire.encode_message(request, {top: wire.decode(signal, data)}) == data


def test_unknown_fields_and_broken_bytes():
    data = wire.encode("logs", batches_of("logs", 1)[0])
    more = data + b"\xba\x3e\x02hi" + b"\xc0\x3e\x05"
    assert wire.decode_message("LogsRequest", more) == wire.decode_message("LogsRequest", data)
    for cut in (1, len(data) // 2, len(data) - 1):
        with pytest.raises(ValueError):
            wire.decode_message("LogsRequest", data[:cut])
    with pytest.raises(ValueError):
        wire.decode_message("LogsRequest", b"\x0d\x00\x00\x00\x00")


def alike(a, b):
    """Equal JSON, where ids stand in hexadecimal and enumerations may be numbers."""
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(base64.b64decode(b[k]).hex() == a[k] if k in ("traceId", "spanId", "parentSpanId") else alike(a[k], b[k]) for k in a)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(alike, a, b))
    return a == b


@pytest.mark.parametrize("encoding", ENCODINGS)
@pytest.mark.parametrize("signal", ["logs", "traces", "metrics"])
def test_every_encoding_and_codec_round_trips(spark, signal, encoding):
    ship(spark)
    rows = batches_of(signal, 12)
    df = spark.createDataFrame([(r,) for r in rows], f"r {otlp.nested(signal)}").withColumn("wire", otlp.encoder(signal, encoding)(F.col("r")))
    x = df
    for codec in CODECS:
        x = x.withColumn(f"b_{codec}", codecs.decompress(codecs.compress(F.col("wire"), codec), codec) == F.col("wire"))
    x = x.withColumn("back", otlp.decoder(signal, encoding)(F.col("wire")))
    request, top, _, _ = model.LEVELS[signal]
    for r, given in zip(x.collect(), rows):
        # the columns' bytes are the messages' own, and the JSON that of the runtime
        if encoding == "otlp_proto":
            assert bytes(r["wire"]) == wire.encode_message(request, {top: given})
        elif wire.classes():
            from google.protobuf import json_format

            want = json_format.MessageToDict(wire.classes()[request].FromString(wire.encode_message(request, {top: given})))
            assert alike(json.loads(bytes(r["wire"])), want)
        plain = lambda c: wire.encode(signal, [v.asDict(True) for v in r[c]])  # noqa: E731, B023
        assert plain("r") == plain("back") and all(r[f"b_{c}"] for c in CODECS)


def test_json_of_others_is_read(spark):
    """Fields in any order, unknown ones, numbers as numbers or strings, and missing levels."""
    doc = {"resourceMetrics": [{"extra": 1, "scopeMetrics": [{"metrics": [{"unit": "1", "name": "m", "histogram": {"aggregationTemporality": 2, "dataPoints": [{"count": 3, "bucketCounts": ["1", "2"], "explicitBounds": [1.5], "timeUnixNano": 7, "attributes": [{"key": "k", "value": {"arrayValue": {"values": [{"intValue": 1}]}}}]}]}}]}]}]}
    df = spark.createDataFrame([(json.dumps(doc),), ("{}",), ("[1]",), ("{",), (None,)], "t string")
    got = [r[0] for r in df.select(otlp.from_otlp_json("metrics", F.col("t"))).collect()]
    m = got[0][0]["scope_metrics"][0]["metrics"][0]
    p = m["histogram"]["data_points"][0]
    assert (m["name"], m["histogram"]["aggregation_temporality"], p["count"], p["bucket_counts"], p["time_unix_nano"], p["sum"]) == ("m", 2, 3, [1, 2], 7, None)
    assert json.loads(p["attributes"][0]["value"]["array_value"]) == {"values": [{"intValue": 1}]}
    assert got[1:] == [[], None, None, None]


@pytest.mark.parametrize("x, want", [(0.0, "0"), (1.0, "1"), (-2.25, "-2.25"), (1e21, "1e+21"), (1e20, "100000000000000000000"), (123456789.125, "123456789.125"), (1e-6, "0.000001"), (1.5e-7, "1.5e-7"), (0.00123, "0.00123"), (3e100, "3e+100"), (float("nan"), "json: unsupported value: NaN")])
def test_doubles_as_text(spark, x, want):
    assert spark.createDataFrame([(x,)], "x double").select(values.number_text(F.col("x"))).first()[0] == want


def test_registries_know_their_names():
    for call in (lambda: otlp.encoder("logs", "x"), lambda: otlp.decoder("x", "otlp_json"), lambda: codecs.compress(F.lit(b""), "lz4") if False else codecs._function(codecs._PACK, "lz4")):
        with pytest.raises(ConfigError):
            call()


def test_damaged_payloads_become_null(spark):
    ship(spark)
    df = spark.createDataFrame([(bytearray(b"junk"),), (None,)], "d binary")
    assert [r[0] for r in df.select(codecs.decompress(F.col("d"), "gzip", strict=False)).collect()] == [None, None]
    assert [r[0] for r in df.select(otlp.decoder("logs", "otlp_proto")(F.col("d"))).collect()] == [None, None]


def test_codecs_on_mixed_bytes():
    data = os.urandom(70_000) + b"a" * 70_000
    for c in CODECS:
        assert codecs._UNPACK[c](codecs._PACK[c](data)) == data and codecs._UNPACK[c](codecs._PACK[c](b"")) == b""
    assert codecs.crc32c(b"123456789") == 0xE3069283
    table = [functools.reduce(lambda c, _: c >> 1 ^ (0x82F63B78 if c & 1 else 0), range(8), i) for i in range(256)]
    for n in (0, 1, 63, 64, 65, 127, 1000, 4097, 65536):
        part = os.urandom(n)
        assert codecs.crc32c(part) == functools.reduce(lambda c, b: c >> 8 ^ table[(c ^ b) & 0xFF], part, 0xFFFFFFFF) ^ 0xFFFFFFFF


def test_datasets_repeat(spark):
    for p in generate.PROFILES:
        assert generate.metrics(spark, p, 50).collect() == generate.metrics(spark, p, 50).collect()
    assert generate.traces(spark, 20).select("span.trace_id", "span.span_id").distinct().count() == 20
    with pytest.raises(ValueError):
        generate.metrics(spark, "x", 1)
    with pytest.raises(ValueError):
        generate.traces(spark, 0)
    text = generate.line_protocol(generate.line_points(spark, total=450)).orderBy("batch").collect()
    assert [r["value"].count("\n") for r in text] == [200, 200, 50] and text[0]["value"].startswith("http_requests,host=h0,region=us-east,instance=inst0 value=0.00 0\n")


@pytest.fixture
def stream_dir(spark, tmp_path):
    rows = [(s, i, f"k{i}", bytearray(f"{s}-{i}".encode())) for s in ("child", "parent", "other") for i in range(5)]
    spark.createDataFrame(rows, shards.SCHEMA).coalesce(1).write.parquet(str(tmp_path / "stream"))
    return str(tmp_path / "stream")


def test_shards_in_batch(spark, stream_dir):
    ship(spark)
    shards.register(spark)
    read = lambda **o: spark.read.format("shards").options(path=stream_dir, **o).load()
    assert read().count() == 15
    got = read(checkpoints=json.dumps({"child": "2", "parent": "SHARD_END", "other": "TRIM_HORIZON"})).groupBy("shard_id").count().collect()
    assert {r[0]: r[1] for r in got} == {"child": 2, "other": 5}
    with pytest.raises(ValueError):
        shards.start_after("SHARD_END")


def drive(spark, stream_dir, out, times, **options):
    """Starts the stream anew for every batch and says what each held."""
    seen = []
    x = spark.readStream.format("shards").options(path=stream_dir, **options).load()

    def sink(batch, n):
        seen.append((n, sorted((r["shard_id"], r["seq"]) for r in batch.collect())))

    for _ in range(times):
        x.writeStream.foreachBatch(sink).option("checkpointLocation", out).trigger(once=True).start().awaitTermination()
    return [rows for _, rows in seen if rows]


def test_a_stream_goes_on_where_it_stopped(spark, stream_dir, tmp_path):
    ship(spark)
    shards.register(spark)
    out = str(tmp_path / "c")
    options = dict(maxRecords="2", parents=json.dumps({"child": ["parent"], "late": ["child"]}), checkpoint=out)
    first = drive(spark, stream_dir, out, 2, **options)
    # a shard that appears later, with sequences far apart, after its parent
    rows = [("late", i * 10**12, "k", bytearray(b"x")) for i in range(1, 6)]
    spark.createDataFrame(rows, shards.SCHEMA).coalesce(1).write.mode("append").parquet(stream_dir)
    got = first + drive(spark, stream_dir, out, 12, **options)
    flat = [r for b in got for r in b]
    assert len(flat) == len(set(flat)) == 20
    place = {s: [i for i, b in enumerate(got) for r in b if r[0] == s] for s in ("parent", "child", "late")}
    assert max(place["parent"]) < min(place["child"]) and max(place["child"]) < min(place["late"])
    assert all(sum(r[0] == s for r in b) <= 2 for b in got for s in ("parent", "child", "other", "late"))


def test_a_restart_without_its_place_never_goes_back(spark, stream_dir):
    class Options(dict):
        pass

    reader = shards.StreamReader(Options(path=stream_dir, maxRecords="2"))
    assert reader.initialOffset() == {"child": -1, "other": -1, "parent": -1} and reader.latestOffset() == {"child": 1, "other": 1, "parent": 1}
    again = shards.StreamReader(Options(path=stream_dir, maxRecords="2"))
    assert again.latestOffset() == {"child": 4, "other": 4, "parent": 4}
    assert [(r.shard, r.after, r.upto) for r in again.partitions({"child": 1, "other": 4, "parent": 4}, {"child": 4, "other": 4, "parent": 4})] == [("child", 1, 4)]


def test_the_nth_record_of_sparse_sequences(spark, tmp_path):
    path = str(tmp_path / "s")
    for part in ([(1, 5), (100, 7)], [(3, 5), (10**15, 9)], [(50, 1)]):
        spark.createDataFrame([("a", q, str(k), bytearray(b"")) for q, k in part] + [("b", q, "", bytearray(b"")) for q, _ in part], shards.SCHEMA).coalesce(1).write.mode("append").parquet(path)
    index = shards.Index(path)
    index.refresh()
    assert [index.nth_after("a", -1, n) for n in (1, 2, 3, 4, 5, 9)] == [1, 3, 50, 100, 10**15, 10**15]
    assert index.nth_after("a", 50, 1) == 100 and index.nth_after("a", 10**15, 3) == 10**15 and index.last("zz") == -1


def test_idempotent_sink_and_audit(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "shard_id string, seq long")
    sink = pipeline.idempotent_sink(str(tmp_path / "out"))
    sink(rows, 0)
    sink(rows, 0)
    got = spark.read.parquet(str(tmp_path / "out"))
    r = audit(rows, got, ["shard_id", "seq"]).first()
    assert (r["loss"], r["dupes"], r["within"]) == (0, 0, True)


def test_observation_state(spark, tmp_path):
    ship(spark)
    spark.createDataFrame([("a", 1, 10), ("a", 1, 20), ("a", 2, 30), ("b", 7, 5)], "shard_id string, counter long, at long").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("shard_id string, counter long, at long").parquet(str(tmp_path / "in"))
    q = pipeline.observe(s).writeStream.format("memory").queryName("seen").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("seen").collect()} == {("a", 2, 30, 1), ("b", 7, 5, 1)}


def test_rows_go_to_python_in_batches_of_few_bytes(spark):
    """A row holds a whole batch of telemetry, so rows alone bound nothing."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.unset(key)
        ship(spark)
        sizes = F.arrow_udf(lambda x: pa.array([len(x)] * len(x), pa.int64()), "long")
        most = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("t")).select(sizes("t").alias("n")).agg(F.max("n")).first()[0]
        assert most <= 10
    finally:
        spark.conf.set(key, seen)


def test_payloads_of_all_codecs_are_read_once_where_they_are_equal(spark, monkeypatch):
    """Every codec is told what its own payloads hold: one that gives other bytes, one that
    gives none, and the rest, which share a reading; no batches are no error."""
    from telestream.plans import reports

    ship(spark)
    read, real = [], reports.receiver.read_records
    monkeypatch.setattr(reports.receiver, "read_records", lambda rows, *a: read.append(rows) or real(rows, *a))
    monkeypatch.setitem(codecs._UNPACK, "zlib", lambda b: b"none")
    monkeypatch.setitem(codecs._UNPACK, "deflate", lambda b: b[:-999] + 1)
    record = otlp.build("LogRecord", time_unix_nano=F.col("id") + 1)
    x = spark.range(3).select(F.array(otlp.build("ResourceLogs", scope_logs=F.array(otlp.build("ScopeLogs", log_records=F.array(record, record))))).alias("resources"))
    for e in ENCODINGS:
        got = {r["codec"]: (r["delivered"], r["items"]) for r in reports._codec_reads(x, "logs", e).collect()}
        assert got == {c: (0, None) if c in ("zlib", "deflate") else (3, 6) for c in CODECS}
        assert read[-1].count() == 9
    assert len(read) == len(ENCODINGS)
    assert sorted(tuple(r) for r in reports._codec_reads(x.filter("false"), "logs", e).collect()) == sorted((c, 0, None) for c in CODECS)


def test_smaller_batches_end_with_what_they_are_for(spark):
    from telestream import packaging

    before = spark.conf.get(packaging.BATCH_KEY)
    with packaging.smaller_batches(spark, 2):
        assert spark.conf.get(packaging.BATCH_KEY) == "2m"
    assert spark.conf.get(packaging.BATCH_KEY) == before
