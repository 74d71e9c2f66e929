import itertools
import random

import pytest
from pyspark.sql import functions as F

from telestream.functions import outcomes
from telestream.operators import delivery, leases, oversize, reports, sending
from telestream.schema import SHARD_END, TRIM_HORIZON
from telestream.streaming import receiver


def halve(sizes, limit, attempts, lo=0, hi=None, depth=0):
    hi = len(sizes) if hi is None else hi
    if sum(sizes[lo:hi]) <= limit:
        return [(lo, hi, depth, "ok")]
    if depth >= attempts:
        return [(lo, hi, depth, "max_attempts")]
    if hi - lo <= 1:
        return [(lo, hi, depth, "irreducible")]
    mid = lo + (hi - lo) // 2
    return halve(sizes, limit, attempts, lo, mid, depth + 1) + halve(sizes, limit, attempts, mid, hi, depth + 1)


def test_halving_matches_recursion(spark):
    rng = random.Random(1)
    cases = [[rng.randrange(1, 12) for _ in range(rng.randrange(1, 20))] for _ in range(40)]
    df = spark.createDataFrame([(i, list(itertools.accumulate(c))) for i, c in enumerate(cases)], "i int, upto array<long>")
    for limit, attempts in ((10, 8), (10, 2)):
        got = oversize.split_ranges(df, "upto", limit, attempts).select("i", "r").collect()
        for i, c in enumerate(cases):
            assert sorted((x["r"]["lo"], x["r"]["hi"], x["r"]["depth"], x["r"]["outcome"]) for x in got if x["i"] == i) == halve(c, limit, attempts)


def test_chunks_close_by_count_and_bytes(spark):
    got = spark.range(1).select(sending.chunks(F.array(*map(F.lit, (3, 3, 3, 9, 1))), 2, 7)).first()[0]
    assert [tuple(x) for x in got] == [(2, 6), (1, 3), (1, 9), (1, 1)]
    assert spark.range(1).select(sending.chunks(F.array().cast("array<int>"), 2, 7)).first()[0] == []


def test_only_transient_entries_are_put_again(spark):
    e = spark.createDataFrame([(i,) for i in range(4)], "id int")
    t = "InternalFailure"
    a = spark.createDataFrame([(1, 1, t), (1, 2, t), (2, 1, "AccessDenied"), *((3, k, t) for k in range(1, 6))], "id int, attempt int, code string")
    got = {r["id"]: (r["attempts"], r["result"]) for r in sending.put_results(e, a, ["id"]).collect()}
    assert got == {0: (1, "sent"), 1: (3, "sent"), 2: (1, "rejected"), 3: (5, "exhausted")}


def test_checkpoint_stops_before_the_first_retry(spark):
    rows = [("a", 1, "OK"), ("a", 2, "Skip"), ("a", 3, "Retry"), ("a", 4, "OK"), ("b", 1, "Retry"), ("c", 5, "OK")]
    got = {r["s"]: (r["checkpoint"], r["stuck"]) for r in delivery.checkpoint_prefix(spark.createDataFrame(rows, "s string, seq long, outcome string"), ["s"]).collect()}
    assert got == {"a": (2, False), "b": (None, True), "c": (5, False)}


def judged(df):
    result, dead = outcomes.outcome(F.col("unpacked"), F.col("decoded"), F.col("error"))
    return df.withColumns({"outcome": result, "failure_class": dead})


@pytest.mark.parametrize("signal, column", [("traces", "name"), ("metrics", "metric"), ("logs", "body")])
def test_dead_letters_have_six_attributes(spark, signal, column):
    df = spark.createDataFrame([("s", 1, "k", bytearray(b"x" * 100), True, False, None)], "shard_id string, seq long, partition_key string, data binary, unpacked boolean, decoded boolean, error string")
    got = delivery.dead_letters(judged(df), signal, "otlp_json", "gzip").collect()
    assert got[0][column] == "kinesis.dead_letter" and len(got[0]["attrs"]) == 6 and "\n" not in got[0]["attrs"]["kinesis.raw"]
    assert delivery.dead_letters(judged(df), signal, "otlp_json", "gzip", enabled=False).count() == 0


def lease_table(spark, rows):
    return spark.createDataFrame([(s, o, 1, c, p, f) for s, o, c, p, f in rows], "shard_id string, owner string, counter long, checkpoint string, parents array<string>, fresh boolean")


def test_drained_needs_every_known_parent_at_its_end(spark):
    t = lease_table(spark, [("p", "", TRIM_HORIZON, [], False), ("q", "", SHARD_END, [], False), ("a", "", TRIM_HORIZON, ["p", "q"], False), ("b", "", TRIM_HORIZON, ["q"], False), ("c", "", TRIM_HORIZON, ["gone"], False)])
    assert {r["shard_id"]: r["drained"] for r in leases.with_drained(t).collect()} == {"p": True, "q": True, "a": False, "b": True, "c": True}


@pytest.mark.parametrize("n, w, want", [(0, 1, 0), (2, 1, 2), (2, 2, 1), (3, 2, 2), (5, 2, 3), (1, 3, 1), (2, 0, 2)])
def test_fair_share(spark, n, w, want):
    assert spark.range(1).select(leases.share(F.lit(n), F.lit(w))).first()[0] == want


def plan(spark, rows, me="me"):
    t = leases.with_drained(lease_table(spark, rows))
    got = leases.plan_actions(t, spark.createDataFrame([(me,)], "self string")).collect()
    return sorted((r["action"], r["shard_id"]) for r in got)


def test_plan_cases(spark):
    free = [(s, "", TRIM_HORIZON, [], False) for s in "ab"]
    assert plan(spark, free) == [("acquire", "a"), ("acquire", "b")]
    mine = [(s, "me", TRIM_HORIZON, [], True) for s in "abc"] + [("d", "you", TRIM_HORIZON, [], True)]
    assert plan(spark, mine) == [("release", "c")]
    yours = [(s, "you", TRIM_HORIZON, [], True) for s in "abcd"]
    assert plan(spark, yours) == [("steal", "a")]
    assert plan(spark, [(s, "you", TRIM_HORIZON, [], False) for s in "ab"]) == [("acquire", "a"), ("acquire", "b")]
    assert plan(spark, [("a", "", SHARD_END, [], False)]) == []
    some = [("a", "", TRIM_HORIZON, [], False), *[(s, "you", TRIM_HORIZON, [], True) for s in "bcdef"]]
    assert plan(spark, some) == [("acquire", "a"), ("steal", "b")]


def test_plans_of_workers_on_snapshots_agree(spark):
    """The plan of a snapshot on the driver and that of tables are one rule."""
    rng = random.Random(3)
    for _ in range(6):
        rows = [(f"s{i:02d}", rng.choice(["", "w1", "w1", "w2", "w3"]), SHARD_END if rng.random() < 0.1 else TRIM_HORIZON, [f"s{rng.randrange(14):02d}"] if rng.random() < 0.3 else [], rng.random() < 0.7) for i in range(rng.randrange(1, 14))]
        ends = {r[0]: r[2] == SHARD_END for r in rows}
        workers = ["w1", "w2", "w9"]
        t = leases.with_drained(lease_table(spark, rows))
        got = sorted((r["self"], r["action"], r["shard_id"]) for r in leases.plan_actions(t, spark.createDataFrame([(w,) for w in workers], "self string")).collect())
        snapshot = [receiver.Row(s, o, c == SHARD_END, f, all(ends.get(p, True) for p in ps)) for s, o, c, ps, f in rows]
        assert got == sorted((w, a, s) for w in workers for a, s in receiver.plan(snapshot, w))


def test_fenced_writes(spark):
    ops = [("ensure", "", 0), ("acquire", "x", 0), ("heartbeat", "y", 1), ("checkpoint", "x", 0), ("checkpoint", "x", 1), ("release", "x", 2), ("delete", "", 1), ("delete", "", 3), ("delete", "", 0), ("heartbeat", "x", 0)]
    df = spark.createDataFrame([("s", i, k, o, n, str(i)) for i, (k, o, n) in enumerate(ops)], "shard string, n long, kind string, owner string, expected long, seq string")
    r = leases.apply_writes(df, "shard", "n").first()
    assert (r["exists"], r["ok"], r["conflicts"], r["missing"]) == (False, 5, 3, 1)


def test_observation_and_discovery(spark):
    now = lease_table(spark, [("a", "w", TRIM_HORIZON, [], True), ("b", "w", TRIM_HORIZON, [], True)])
    old = spark.createDataFrame([("a", 1, 5), ("gone", 1, 5)], "shard_id string, counter long, seen_at long")
    assert {r["shard_id"]: r["seen_at"] for r in leases.refresh(now, old, 9).collect()} == {"a": 5, "b": 9}
    shards = spark.createDataFrame([("a", []), ("n", ["a"])], "shard_id string, parents array<string>")
    assert [r["shard_id"] for r in leases.discover(shards, now).collect()] == ["n"]


def test_reaping_needs_three_absent_passes_in_a_row(spark):
    rows = [(p, "live", True, False, False) for p in range(1, 8)] + [(p, "a", p == 3, True, False) for p in range(1, 8)] + [(p, "b", False, False, False) for p in range(1, 8)]
    df = spark.createDataFrame(rows, "pass long, shard_id string, listed boolean, ended boolean, busy boolean")
    assert [(r["shard_id"], r["pass"]) for r in leases.reaped(df).collect()] == [("a", 6)]


def test_lease_rows_round_trip(spark):
    t = lease_table(spark, [("a", "w", TRIM_HORIZON, ["p", "q"], True), ("b", "", SHARD_END, [], False)]).drop("fresh")
    stored = leases.marshal(t)
    assert {r["leaseKey"]: (r["leaseOwner"], r["parentShardId"]) for r in stored.collect()} == {"a": ("w", "p,q"), "b": (None, None)}
    assert sorted(leases.unmarshal(stored).collect()) == sorted(t.collect())


def test_ownership(spark):
    t = lease_table(spark, [(s, o, TRIM_HORIZON, [], True) for s, o in zip("abcde", ["x", "y", "x", "", "y"])])
    r = leases.ownership(t).first()
    assert tuple(r) == (4, 5, 2, "x=2;y=2;", True)


def test_nearest_rank(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4)], "g string, v double")
    assert df.groupBy("g").agg(reports.nearest_rank("v", 0.9).alias("p")).first()["p"] == 3.0
    assert reports.rank_table(df, ["g"], "v", {"p90": 0.9}).first()["p90"] == 3.0


def test_reports(spark):
    lines = ["BenchmarkEncodeMetrics/p/otlp_proto/zstd/n=10-6\t 5\t 12.5 ns/op\t 482 compressed_bytes\t 2.04 compression_ratio\t 48.2 compressed_bytes_per_record\t 8700 p50_ns\t 9800 p90_ns", "BenchmarkEncodeMetrics/p/otlp_json/zstd/n=10-6", "ok"]
    rows = reports.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows.count() == 2
    r = reports.summary(rows, "Encode", "metrics", "p").first().asDict()
    assert r["otlp_proto_p50"] == "8.7µs" and r["otlp_proto_ratio"] == "2.04×" and r["otlp_json_p50"] == "—"
    assert reports.details(rows, "Encode", "metrics", "p").count() == 1
