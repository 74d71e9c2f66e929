import random

import pytest
import xxhash
from pyspark.sql import functions as F

from telestream.config import KeySource, WriterConfig
from telestream.functions import keys, outcomes, text


def one(spark, expr, **values):
    return spark.range(1).select(expr).first()[0]


@pytest.mark.parametrize("pattern, value, want", [("^([a-z]+)_", "foo_a", "foo"), ("[a-z]+", "123x", "x"), ("^([a-z]+)_", "123", ""), ("(a)|b", "b", ""), ("x", "", "")])
def test_first_capture(spark, pattern, value, want):
    assert one(spark, keys.first_capture(F.lit(value), pattern)) == want


def test_key_hash_is_seed_0(spark):
    words = ["", "a", "é", "x" * 100, "a\u001fb"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(keys.partition_key(F.col("w"))).collect()
    assert [r[0] for r in got] == [f"{xxhash.xxh64(w.encode(), seed=0).intdigest():016x}" for w in words]


def test_plan_and_parts(spark):
    cfg = WriterConfig(strategy="tag_hash", keys=(KeySource("", "svc"), KeySource("datapoint", "port"), KeySource("metric_name", regex="^([a-z]+)_", promote="ns")))
    plan = keys.compile_plan(cfg)
    assert keys.compile_plan(WriterConfig()) is None and not keys.resource_only(plan) and keys.promotes(plan)
    assert keys.resource_only(keys.compile_plan(WriterConfig(strategy="tag_hash", tags=("a", "b"))))
    df = spark.sql("SELECT map('svc', 'A') res, map('port', '8080') leaf, 'foo_x' m")
    parts = keys.resolve_parts(plan, F.col("res"), F.col("m"), F.col("leaf"))
    res, leaf = keys.promote(plan, parts, F.col("res"), F.col("leaf"))
    row = df.select(keys.join_parts(parts).alias("k"), res.alias("r"), leaf.alias("l")).first()
    assert row["k"] == "A\u001f8080\u001ffoo" and row["r"] == {"svc": "A"} and row["l"] == {"port": "8080", "ns": "foo"}


def test_promotion_keeps_what_is_there(spark):
    m = F.create_map(F.lit("ns"), F.lit("old"))
    assert one(spark, keys.put_if_absent(m, "ns", F.lit("new"))) == {"ns": "old"}
    assert one(spark, keys.put_if_absent(m, "x", F.lit(""))) == {"ns": "old"}


@pytest.mark.parametrize("value", ["héllo", "", "中文字", "a😀b", "abcdef"])
def test_cut_ends_between_code_points(spark, value):
    for most in range(1, 9):
        data, n = value.encode(), most
        while n > 0 and len(data) > most and data[n] & 0xC0 == 0x80:
            n -= 1
        want = value if len(data) <= most else data[:n].decode()
        assert one(spark, text.utf8_cut(F.lit(value), most)) == want


def test_clamp_counts_changes(spark):
    cut, n = text.clamp_map(F.create_map(F.lit("a"), F.lit("xxxx"), F.lit("b"), F.lit("y")), 2)
    assert one(spark, cut) == {"a": "xx", "b": "y"} and one(spark, n) == 1


def test_delays(spark):
    put = [one(spark, outcomes.put_delay(F.lit(i))) for i in (0, 1, 4, 5, 60)]
    assert put == [100, 200, 1600, 2000, 2000]
    assert [one(spark, outcomes.stuck_delay(F.lit(i), 100)) for i in (0, 1, 2, 3, 4, 100)] == [100, 100, 200, 400, 800, 30000]


def test_display_and_hash(spark):
    got = [one(spark, f(F.lit(v))) for f, v in ((text.show_ns, 750.0), (text.show_ns, 5300.0), (text.show_bytes, 182.0), (text.show_bytes, 2048.0), (text.show_ratio, 1.5), (text.show_per_record, 0.5))]
    assert got == ["750ns", "5.3µs", "182B", "2.0KiB", "1.50×", "0.50B"]
    h = 2166136261
    for b in "metrics-é".encode():
        h = (h ^ b) * 16777619 % 2**32
    assert one(spark, keys.fnv1a32(F.lit("metrics-é"))) == h and one(spark, keys.fnv1a32(F.lit(""))) == 2166136261
    assert one(spark, text.namespace_of(F.lit("http_x"))) == "http" and one(spark, text.namespace_of(F.lit("_x"))) == "_x"


def test_decimals_of_every_size(spark):
    """As C's formatter writes the exact binary value, from the least to 37 digits."""
    rng = random.Random(2)
    values = [m * 2.0**k for k in range(-60, 122) for m in (1.0, 1.5, rng.random() + 1, rng.random() + 1)]
    values += [0.0, 0.125, 0.125 + 2**-55, 2.5, 0.5, 2.0**40 - 0.5, 2.0**40 + 0.125, 2.0**41 + 0.375, 2.0**50 + 0.75, 2.0**52 + 0.5, 2.0**53, 7.5e13 / 4, 9.2e18, 1e23, -0.125, -3e15]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2):
        got = [r[0] for r in df.select(text.fixed(F.col("x"), digits)).collect()]
        assert [(v, g) for v, g in zip(values, got) if g != f"{v:.{digits}f}"] == []
    shown = df.select(text.show_bytes((F.col("x") * 0 + 2.0**62).cast("long")), text.show_ratio(F.lit(2.0**62)), text.show_ns(F.lit(2.0**62)), text.show_per_record(F.lit(2.0**62))).first()
    assert tuple(shown) == ("4398046511104.00MiB", "4611686018427387904.00×", "4611686018.43s", "4503599627370496.0KiB")
