"""Queries over keys, groups, promotion, clamping and splitting."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import KeySource
from ..functions import keys, text, values
from ..operators import exporting, grouping, oversize
from ..schema import attrs, datapoints, logs, table
from ..sources import otlp
from ..sources.model import LEVELS
from . import batches

USER, TYPE, K = KeySource(name="user"), KeySource("datapoint", "type"), KeySource("datapoint", "k")
PREFIX = KeySource("metric_name", regex="^([a-z]+)_", promote="namespace")


def logs_tag_groups(spark, d):
    x = grouping.keyed(logs(spark, d), (USER, TYPE))
    return x.groupBy("tag").agg(F.count("*").alias("items"), F.sum(F.octet_length("data")).alias("bytes"), F.min("k").alias("first"))


def _nested_counts(groups, signal):
    """(batch_id, tag, resources, scopes, items) of rebuilt groups."""
    _, _, mid, _ = LEVELS[signal]
    scopes = F.aggregate("resources", F.lit(0), lambda n, r: n + F.size(r[mid]))
    return groups.select("batch_id", "tag", F.size("resources").alias("resources"), scopes.alias("scopes"), exporting.item_count(signal, F.col("resources")).alias("items"))


def logs_leaf_groups(spark, d):
    return _nested_counts(grouping.group_batches(batches.log_batches(spark, d), "logs", (K,)), "logs")


def group_dispatch(spark, d):
    """Groups and items of each signal without a plan, by resource and by leaf."""
    out = None
    plans = {"none": None, "resource": {"logs": USER, "traces": KeySource(name="cust"), "metrics": KeySource(name="supp")}, "leaf": {"logs": K, "traces": KeySource("datapoint", "flag"), "metrics": KeySource("metric_name")}}
    for signal, made in (("logs", batches.log_batches), ("traces", batches.span_batches), ("metrics", batches.metric_batches)):
        own = made(spark, d)
        for name, plan in plans.items():
            g = _nested_counts(grouping.group_batches(own, signal, (plan[signal],) if plan else None), signal)
            g = g.agg(F.count("*").alias("groups"), F.sum("resources").alias("resources"), F.sum("items").alias("items")).select(F.lit(signal).alias("signal"), F.lit(name).alias("path"), "*")
            out = g if out is None else out.unionByName(g)
    return out


def group_order(spark, d):
    """The place of each group among its batch's groups, in first-seen order."""
    g = grouping.group_batches(batches.log_batches(spark, d), "logs", (KeySource("datapoint", "k", regex="([0-9])$"),))
    return g.select("batch_id", "tag", F.row_number().over(Window.partitionBy("batch_id").orderBy("first")).alias("place"))


def metrics_leaf_groups(spark, d):
    """Metrics of each key with kind, temporality, monotonicity and points; bare shells too."""
    g = grouping.group_batches(batches.metric_batches(spark, d), "metrics", (KeySource("metric_name", regex="^([a-z]+)", promote="family"), KeySource(name="supp")))
    m = g.select("tag", F.explode("resources").alias("r")).select("tag", F.explode("r.scope_metrics").alias("s")).select("tag", F.explode("s.metrics").alias("m"))
    sums = F.col("m")["sum"]
    family = F.aggregate(F.coalesce(sums["data_points"], F.array()), F.lit(0), lambda n, p: n + F.when(values.read(p["attributes"], "family") != "", 1).otherwise(0))
    rows = m.select("tag", F.col("m.name").alias("name"), otlp.kind_of(F.col("m")).alias("kind"), otlp.temporality(F.col("m")).alias("temporality"), F.coalesce(sums["is_monotonic"], F.lit(False)).alias("monotonic"), otlp.points(F.col("m")).alias("points"), family.alias("promoted"))
    return rows.groupBy("tag", "name", "kind", "temporality", "monotonic").agg(F.sum("points").alias("points"), F.sum("promoted").alias("promoted"))


def typed_keys(spark, d):
    """Keys made of values of every kind, by their text."""
    x = table(spark, d, "events").select("event_id", (F.col("event_id") % 8).alias("kind"))
    none = values.text_value(F.lit(None).cast("string"))
    i = F.col("event_id")
    of = [values.text_value(F.concat(F.lit("s"), i)), none.withField("bool_value", i % 3 == 0), values.int_value(-i), none.withField("double_value", i / 4.0), none.withField("bytes_value", F.encode(i.cast("string"), "utf-8")), none.withField("array_value", F.concat(F.lit('{"values":[{"intValue":"'), i, F.lit('"},{"stringValue":"a"}]}'))), none.withField("kvlist_value", F.concat(F.lit('{"values":[{"key":"b","value":{"intValue":"'), i, F.lit('"}},{"key":"a","value":{"boolValue":true}}]}'))), none]
    value = F.element_at(F.array(*of), F.col("kind").cast("int") + 1)
    tag = values.read(F.array(values.pair("key", value)).cast(values.PAIRS), "key")
    return x.select("event_id", tag.alias("tag"))


def metrics_name_regex(spark, d):
    x = grouping.keyed(datapoints(spark, d), (KeySource("metric_name", regex="^([a-z]+)_"),), metric="metric")
    return x.groupBy("tag").agg(F.count("*").alias("points"), F.sum(F.round(F.col("double_value") * 100).cast("long")).alias("cents"))


def metrics_whole_match(spark, d):
    x = grouping.keyed(datapoints(spark, d), (KeySource("metric_name", regex="[nr]_[a-z]"),), metric="metric")
    return x.groupBy("tag").agg(F.count("*").alias("points"))


def metrics_mixed_plan(spark, d):
    plan = (KeySource(name="supp"), KeySource("datapoint", "part", regex="([0-9])$"), KeySource("metric_name"))
    x = grouping.keyed(datapoints(spark, d), plan, metric="metric")
    return x.groupBy("tag").agg(F.count("*").alias("points"))


def metrics_zero_datapoint_shell(spark, d):
    p, x = table(spark, d, "part"), table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("points"))
    shells = p.join(x, "p_partkey", "left").withColumn("res", attrs(brand=F.col("p_brand")))
    found = grouping.keyed(shells, (KeySource(name="brand"),), leaf=None)
    return found.groupBy("tag").agg(F.count("*").alias("metrics"), F.sum(F.coalesce("points", F.lit(0))).cast("long").alias("points"), F.count_if(F.col("points").isNull()).alias("empty"))


def spans_by_resource(spark, d):
    return _nested_counts(grouping.group_batches(batches.span_batches(spark, d), "traces", (KeySource(name="cust"),)), "traces")


def spans_by_leaf(spark, d):
    return _nested_counts(grouping.group_batches(batches.span_batches(spark, d), "traces", (KeySource("datapoint", "flag"),)), "traces")


def key_xxhash_routing(spark, d):
    x = grouping.keyed(logs(spark, d), (USER, TYPE)).groupBy("tag").agg(F.count("*").alias("items"))
    key = keys.partition_key(F.col("tag"))
    return x.select("tag", key.alias("partition_key"), F.pmod(keys.xxh64(F.col("tag")), F.lit(4)).cast("int").alias("shard"), "items")


def key_separator_no_collision(spark, d):
    x = grouping.keyed(logs(spark, d), (USER, K)).withColumn("plain", F.concat(F.col("res")["user"], F.col("attrs")["k"]))
    return x.agg(F.countDistinct(F.col("res")["user"], F.col("attrs")["k"]).alias("tuples"), F.countDistinct(F.md5("tag")).alias("keys"), F.countDistinct("plain").alias("without_separator"))


def promote_namespace(spark, d):
    x = grouping.keyed(datapoints(spark, d), (PREFIX,), metric="metric")
    return x.groupBy(F.col("attrs")["namespace"].alias("namespace")).agg(F.count("*").alias("points"), F.min(F.size("attrs")).cast("int").alias("attributes"))


def promote_absent_only(spark, d):
    plan = (KeySource("metric_name", regex="^([a-z]+)_", promote="part"), KeySource("metric_name", regex="_([a-z]+)$", promote="status"))
    x = grouping.keyed(datapoints(spark, d).withColumn("was", F.col("attrs")["part"]), plan, metric="metric")
    return x.groupBy(F.col("attrs")["status"].alias("status")).agg(F.count("*").alias("points"), F.count_if(F.col("attrs")["part"] == F.col("was")).alias("kept"))


def clamp_attributes(spark, d):
    x = table(spark, d, "documents").select("lang", attrs(text=F.col("text"), source=F.col("source")).alias("attrs"))
    x = oversize.clamp_columns(x, ["attrs"], 1000)
    return x.groupBy("lang").agg(F.sum("clamped").cast("long").alias("clamped"), F.sum(F.octet_length(F.col("attrs")["text"])).cast("long").alias("bytes"))


def clamp_utf8_boundary(spark, d):
    cut = text.utf8_cut(F.col("text"), 37)
    return table(spark, d, "documents").select("doc_id", F.octet_length(cut).alias("bytes"), F.md5(cut).alias("digest"))


def _ranges(spark, d, limit, attempts):
    o = table(spark, d, "orders").withColumn("s", F.octet_length("o_orderpriority"))
    o = o.withColumn("upto", F.sum("s").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    o = o.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "upto"))).alias("o")).select("o_custkey", F.col("o.upto").alias("upto"))
    return oversize.split_ranges(o, "upto", limit, attempts).select("o_custkey", "r.lo", "r.hi", "r.depth", "r.outcome")


def split_half_ranges(spark, d):
    return _ranges(spark, d, 24, 8)


def _lost(ranges):
    return ranges.filter("outcome <> 'ok'").select(F.col("outcome").alias("reason"), (F.col("hi") - F.col("lo")).cast("long").alias("n"))


def split_reasons(spark, d):
    """Drops of two passes under other limits, merged by reason."""
    return grouping.merge_drops(_lost(_ranges(spark, d, 12, 3)), _lost(_ranges(spark, d, 16, 2)))


def split_metric_levels(spark, d):
    """Metrics halved at each level: batches at their resources, single resources at their
    metrics, single metrics at their points; nothing is lost between the halves."""
    whole = batches.metric_batches(spark, d)
    x = whole.select("batch_id", F.explode("resources").alias("r"))
    filled = F.transform("r.scope_metrics", lambda s: s.withField("metrics", F.filter(s["metrics"], lambda m: otlp.points(m) > 0)))
    first = F.col("r").withField("scope_metrics", F.transform(filled, lambda s: s.withField("metrics", F.slice(s["metrics"], 1, 1))))
    out = None
    for level, rows in (("resource", whole.select("resources")), ("metric", x.select(F.array("r").alias("resources"))), ("datapoint", x.select(F.array(first).alias("resources")))):
        can, left, right = exporting.halves("metrics", F.col("resources"))
        rows = rows.select(can.alias("can"), left.alias("a"), right.alias("b"), exporting.item_count("metrics", F.col("resources")).alias("n"))
        n = lambda c: F.coalesce(exporting.item_count("metrics", F.col(c)), F.lit(0))
        rows = rows.agg(F.count("*").alias("batches"), F.count_if("can").alias("halved"), F.sum(F.when(F.col("can"), F.col("n")).otherwise(0)).alias("items"), F.sum(n("a")).alias("left_items"), F.sum(n("b")).alias("right_items"))
        rows = rows.select(F.lit(level).alias("level"), "batches", "halved", "items", (F.col("left_items") + F.col("right_items") == F.col("items")).alias("whole"))
        out = rows if out is None else out.unionByName(rows)
    return out


def first_seen_order(spark, d):
    x = grouping.first_seen(grouping.keyed(logs(spark, d), (TYPE, K)), "tag", "k")
    earlier = x.orderBy("first")
    return earlier.select("tag", F.col("first"), "items")


def fnv1a32(spark, d):
    return table(spark, d, "part").select("p_name").distinct().select("p_name", keys.fnv1a32(F.col("p_name")).alias("hash"))


QUERIES = {f.__name__: f for f in (group_dispatch, group_order, metrics_leaf_groups, typed_keys, logs_tag_groups, logs_leaf_groups, metrics_name_regex, metrics_whole_match, metrics_mixed_plan, metrics_zero_datapoint_shell, spans_by_resource, spans_by_leaf, key_xxhash_routing, key_separator_no_collision, promote_namespace, promote_absent_only, clamp_attributes, clamp_utf8_boundary, split_half_ranges, split_reasons, split_metric_levels, first_seen_order, fnv1a32)}

METRIC = "concat(lower(l_returnflag), '_', lower(l_linestatus))"
KEY = "json_extract_string(props, '$.k')"


def _cut_sql(most: int) -> str:
    """The clamped text, by the first byte place that begins a code point."""
    byte = lambda k: f"(('0x' || hex(array_slice(encode(text), {k + 1}, {k + 1})))::int & 192)"
    place = "0"
    for k in range(most - 3, most + 1):
        place = f"CASE WHEN {byte(k)} <> 128 THEN {k} ELSE {place} END"
    return f"CASE WHEN strlen(text) <= {most} THEN text ELSE decode(array_slice(encode(text), 1, {place})) END"


def _ranges_sql(limit: int, attempts: int) -> str:
    return f"""WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, strlen(o_orderpriority) AS s, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
 c AS (SELECT o_custkey, rn, sum(s) OVER (PARTITION BY o_custkey ORDER BY rn) AS upto FROM o),
 p AS (SELECT o_custkey, rn, upto FROM c UNION ALL SELECT DISTINCT o_custkey, 0, 0 FROM o),
 r AS (SELECT o_custkey, 0::BIGINT AS lo, max(rn)::BIGINT AS hi, 0 AS depth, max(upto)::BIGINT AS size FROM p GROUP BY o_custkey
   UNION ALL
   SELECT o_custkey, lo, hi, depth, (b.upto - a.upto)::BIGINT FROM (
     SELECT r.o_custkey, CASE WHEN h = 0 THEN lo ELSE lo + (hi - lo) // 2 END AS lo, CASE WHEN h = 0 THEN lo + (hi - lo) // 2 ELSE hi END AS hi, depth + 1 AS depth
     FROM r CROSS JOIN (VALUES (0), (1)) v(h) WHERE size > {limit} AND depth < {attempts} AND hi - lo > 1) q
   JOIN p a USING (o_custkey) JOIN p b USING (o_custkey) WHERE a.rn = lo AND b.rn = hi),
 leaf AS (SELECT o_custkey, lo::INT AS lo, hi::INT AS hi, depth::INT AS depth, CASE WHEN size <= {limit} THEN 'ok' WHEN depth >= {attempts} THEN 'max_attempts' ELSE 'irreducible' END AS outcome
   FROM r WHERE size <= {limit} OR depth >= {attempts} OR hi - lo <= 1)"""



#: Multipliers of XXH64 (fixed values).
_P = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def _xxh64_sql(source: str) -> str:
    """WITH list that ends in ``hashed`` (tag, h): XXH64 with seed 0 of tags under 32 bytes,
    in 128-bit arithmetic. Each step replaces one running value."""
    u = lambda n: f"{n}::UHUGEINT"
    two64 = u(1 << 64)
    p1, p2, p3, p4, p5 = map(u, _P)
    mul = lambda a, b: f"(({a}) * {b} % {two64})"
    rot = lambda a, r: f"(({a}) * {u(1 << r)} % {two64} + ({a}) // {u(1 << (64 - r))})"
    add = lambda a, b: f"((({a}) + {b}) % {two64})"
    out = [f"s0 AS (SELECT tag, encode(tag) AS b, strlen(tag)::BIGINT AS n, {p5} + strlen(tag)::UHUGEINT AS h, 0::BIGINT AS o FROM ({source}))"]

    def absorb(width: int, value: list[str], state: list[str]) -> None:
        k = len(out)
        lane = " + ".join(f"('0x' || hex(array_slice(b, o + {i + 1}, o + {i + 1})))::UHUGEINT * {u(256**i)}" for i in range(width))
        out.append(f"s{k} AS (SELECT *, CASE WHEN n - o >= {width} THEN {lane} END AS v FROM s{k - 1})")
        for name, e in [("v", x) for x in value] + [("h", f"CASE WHEN v IS NULL THEN h ELSE {x} END") for x in state]:
            out.append(f"s{len(out)} AS (SELECT * REPLACE ({e} AS {name}) FROM s{len(out) - 1})")
        out.append(f"s{len(out)} AS (SELECT tag, b, n, h, CASE WHEN v IS NULL THEN o ELSE o + {width} END AS o FROM s{len(out) - 1})")

    for _ in range(3):
        absorb(8, [mul("v", p2), rot("v", 31), mul("v", p1)], ["xor(h, v)", rot("h", 27), add(mul("h", p1), p4)])
    absorb(4, [mul("v", p1)], ["xor(h, v)", rot("h", 23), add(mul("h", p2), p3)])
    for _ in range(3):
        absorb(1, [mul("v", p5)], ["xor(h, v)", rot("h", 11), mul("h", p1)])
    for e in (f"xor(h, h // {u(1 << 33)})", mul("h", p2), f"xor(h, h // {u(1 << 29)})", mul("h", p3), f"xor(h, h // {u(1 << 32)})"):
        out.append(f"s{len(out)} AS (SELECT tag, {e} AS h FROM s{len(out) - 1})")
    return "WITH " + ", ".join(out) + f", hashed AS (SELECT * FROM s{len(out) - 1})"


def _dispatch_sql() -> str:
    """Of each signal: the groups of the three paths."""
    e, o = batches.EVENTS, batches.LINES
    sides = {
        "logs": ("events", f"event_id // {e}", "user_id", KEY, 0),
        "traces": ("(SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey)", f"o_orderkey // {o}", "o_custkey", "l_returnflag", 0),
        "metrics": ("lineitem", f"l_orderkey // {o}", "l_suppkey", METRIC, 1),
    }
    out = []
    for signal, (t, b, r, leaf, shells) in sides.items():
        out.append(f"SELECT '{signal}' AS signal, 'none' AS path, count(DISTINCT {b})::BIGINT AS groups, count(DISTINCT ({b}, {r}))::BIGINT AS resources, count(*)::BIGINT AS items FROM {t}")
        out.append(f"SELECT '{signal}', 'resource', count(DISTINCT ({b}, {r})), count(DISTINCT ({b}, {r})), count(*) FROM {t}")
        # every batch of metrics has one more group, of the bare shells, with all its resources
        out.append(f"SELECT '{signal}', 'leaf', count(DISTINCT ({b}, {leaf})) + {shells} * count(DISTINCT {b}), count(DISTINCT ({b}, {leaf}, {r})) + {shells} * count(DISTINCT ({b}, {r})), count(*) FROM {t}")
    return " UNION ALL ".join(out)


def _levels_sql() -> str:
    o = batches.LINES
    return f"""WITH x AS (SELECT l_orderkey // {o} AS b, l_suppkey AS r, {METRIC} AS m FROM lineitem),
 r AS (SELECT b, r, count(DISTINCT m) + 1 AS metrics, count(*) AS n FROM x GROUP BY 1, 2),
 f AS (SELECT b, r, m, count(*) AS n, row_number() OVER (PARTITION BY b, r ORDER BY m) AS k FROM x GROUP BY 1, 2, 3),
 w AS (SELECT b, count(*) AS resources, sum(n) AS n FROM r GROUP BY 1)
 SELECT 'resource' AS level, count(*) AS batches, count(*) AS halved, sum(n)::BIGINT AS items, true AS whole FROM w
 UNION ALL SELECT 'metric', count(*), count(*) FILTER (metrics > 1), sum(n)::BIGINT, true FROM r
 UNION ALL SELECT 'datapoint', count(*), count(*) FILTER (n > 1), (sum(n) FILTER (n > 1))::BIGINT, true FROM f WHERE k = 1"""


_TAGS = "SELECT concat_ws(chr(31), user_id::VARCHAR, event_type) AS tag, count(*) AS items FROM events GROUP BY 1"

ORACLES = {
    "logs_tag_groups": "SELECT concat_ws(chr(31), user_id::VARCHAR, event_type) AS tag, count(*) AS items, sum(strlen(props))::BIGINT AS bytes, min(event_id) AS first FROM events GROUP BY 1",
    "logs_leaf_groups": f"SELECT (event_id // {batches.EVENTS})::BIGINT AS batch_id, {KEY} AS tag, count(DISTINCT user_id)::INT AS resources, count(DISTINCT (user_id, event_type))::INT AS scopes, count(*)::INT AS items FROM events GROUP BY 1, 2",
    "group_order": f"WITH g AS (SELECT (event_id // {batches.EVENTS})::BIGINT AS batch_id, regexp_extract({KEY}, '([0-9])$', 1) AS tag, min((user_id, event_type, event_id)) AS first FROM events GROUP BY 1, 2) SELECT batch_id, tag, row_number() OVER (PARTITION BY batch_id ORDER BY first)::INT AS place FROM g",
    "group_dispatch": _dispatch_sql(),
    "metrics_leaf_groups": f"WITH x AS (SELECT l_orderkey // {batches.LINES} AS b, l_suppkey, {METRIC} AS name, lower(l_returnflag) AS f FROM lineitem), m AS (SELECT f || chr(31) || l_suppkey AS tag, name, CASE f WHEN 'n' THEN 'gauge' WHEN 'a' THEN 'sum' ELSE 'histogram' END AS kind, CASE f WHEN 'n' THEN 0 WHEN 'a' THEN 1 ELSE 2 END::INT AS temporality, f = 'a' AS monotonic, count(*)::BIGINT AS points, (count(*) FILTER (f = 'a'))::BIGINT AS promoted FROM x GROUP BY ALL) SELECT * FROM m UNION ALL SELECT DISTINCT 'idle' || chr(31) || l_suppkey, 'idle', 'empty', 0, false, 0, 0 FROM x",
    "typed_keys": "SELECT event_id, CASE event_id % 8 WHEN 0 THEN 's' || event_id WHEN 1 THEN (event_id % 3 = 0)::VARCHAR WHEN 2 THEN (-event_id)::VARCHAR WHEN 3 THEN CASE WHEN event_id % 4 = 0 THEN (event_id // 4)::VARCHAR ELSE (event_id / 4.0)::DOUBLE::VARCHAR END WHEN 4 THEN to_base64(encode(event_id::VARCHAR)) WHEN 5 THEN '[' || event_id || ',\"a\"]' WHEN 6 THEN '{\"a\":true,\"b\":' || event_id || '}' ELSE '' END AS tag FROM events",
    "metrics_name_regex": f"SELECT regexp_extract({METRIC}, '^([a-z]+)_', 1) AS tag, count(*) AS points, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents FROM lineitem GROUP BY 1",
    "metrics_whole_match": f"SELECT regexp_extract({METRIC}, '[nr]_[a-z]') AS tag, count(*) AS points FROM lineitem GROUP BY 1",
    "metrics_mixed_plan": f"SELECT concat_ws(chr(31), l_suppkey::VARCHAR, regexp_extract(l_partkey::VARCHAR, '([0-9])$', 1), {METRIC}) AS tag, count(*) AS points FROM lineitem GROUP BY 1",
    "metrics_zero_datapoint_shell": "SELECT p_brand AS tag, count(*) AS metrics, sum(coalesce(n, 0))::BIGINT AS points, count(*) FILTER (n IS NULL) AS empty FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) x ON l_partkey = p_partkey GROUP BY 1",
    "spans_by_resource": f"SELECT (o_orderkey // {batches.LINES})::BIGINT AS batch_id, o_custkey::VARCHAR AS tag, 1 AS resources, count(DISTINCT o_orderpriority)::INT AS scopes, count(*)::INT AS items FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2",
    "spans_by_leaf": f"SELECT (o_orderkey // {batches.LINES})::BIGINT AS batch_id, l_returnflag AS tag, count(DISTINCT o_custkey)::INT AS resources, count(DISTINCT (o_custkey, o_orderpriority))::INT AS scopes, count(*)::INT AS items FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2",
    "key_xxhash_routing": _xxh64_sql(f"SELECT tag FROM ({_TAGS})") + f" SELECT tag, lower(lpad(to_hex(h::UBIGINT), 16, '0')) AS partition_key, (h % 4)::INT AS shard, items FROM hashed JOIN ({_TAGS}) USING (tag)",
    "key_separator_no_collision": f"SELECT count(DISTINCT (user_id, {KEY})) AS tuples, count(DISTINCT md5(concat_ws(chr(31), user_id::VARCHAR, {KEY}))) AS keys, count(DISTINCT user_id::VARCHAR || {KEY}) AS without_separator FROM events",
    "promote_namespace": f"SELECT regexp_extract({METRIC}, '^([a-z]+)_', 1) AS namespace, count(*) AS points, 2 AS attributes FROM lineitem GROUP BY 1",
    "promote_absent_only": "SELECT lower(l_linestatus) AS status, count(*) AS points, count(*) AS kept FROM lineitem GROUP BY 1",
    "clamp_attributes": f"SELECT lang, sum((strlen(text) > 1000)::INT)::BIGINT AS clamped, sum(strlen({_cut_sql(1000)}))::BIGINT AS bytes FROM documents GROUP BY 1",
    "clamp_utf8_boundary": f"SELECT doc_id, strlen(c)::INT AS bytes, md5(c) AS digest FROM (SELECT doc_id, {_cut_sql(37)} AS c FROM documents)",
    "split_half_ranges": _ranges_sql(24, 8) + " SELECT * FROM leaf",
    "split_reasons": f"SELECT outcome AS reason, sum(n)::BIGINT AS n FROM (SELECT outcome, hi - lo AS n FROM ({_ranges_sql(12, 3)} SELECT * FROM leaf) UNION ALL SELECT outcome, hi - lo FROM ({_ranges_sql(16, 2)} SELECT * FROM leaf)) WHERE outcome <> 'ok' GROUP BY 1",
    "split_metric_levels": _levels_sql(),
    "first_seen_order": f"SELECT concat_ws(chr(31), event_type, {KEY}) AS tag, min(event_id) AS first, count(*) AS items FROM events GROUP BY 1 ORDER BY first",
    "fnv1a32": "SELECT p_name, list_reduce(list_concat([2166136261::BIGINT], list_transform(range(1, strlen(p_name)::BIGINT + 1), lambda i: ('0x' || hex(array_slice(encode(p_name), i, i)))::BIGINT)), lambda h, b: (xor(h, b) * 16777619) % 4294967296) AS hash FROM (SELECT DISTINCT p_name FROM part)",
}
