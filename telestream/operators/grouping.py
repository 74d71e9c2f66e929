"""Grouping of telemetry by key and rebuilding of the shells around its leaves.

Batches are rows of (batch_id, resources) with resources of the type ``sources.otlp.nested``.
A batch is grouped by itself: leaves of two batches are never merged, and groups come in
the order in which a batch first shows their key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import KeySource
from ..functions import keys, values
from ..sources import otlp
from ..sources.model import LEVELS


def keyed(df: DataFrame, plan: Sequence[KeySource], res: str = "res", metric: str | None = None, leaf: str | None = "attrs", out: str = "tag") -> DataFrame:
    """Adds the joined key of each row of a flat table and writes promoted parts back."""
    name = F.col(metric) if metric else F.lit("")
    below = F.col(leaf) if leaf else F.create_map().cast("map<string,string>")
    parts = keys.resolve_parts(plan, F.col(res), name, below)
    found = df.withColumn(out, keys.join_parts(parts))
    if keys.promotes(plan):
        on_res, on_leaf = keys.promote(plan, parts, F.col(res), below)
        found = found.withColumn(res, on_res) if not leaf else found.withColumns({res: on_res, leaf: on_leaf})
    return found


def in_order(items: Column, by: str) -> Column:
    """Structs by one field, for they may hold what has no order."""
    return F.array_sort(items, lambda a, b: F.when(a[by] < b[by], -1).when(a[by] > b[by], 1).otherwise(0))


def _gather(order: Column, value: Column) -> Column:
    return F.transform(in_order(F.collect_list(F.struct(order.alias("o"), value.alias("v"))), "o"), lambda x: x["v"])


def _parts(plan: Sequence[KeySource], res: Column, metric: Column, leaf: Column) -> list[Column]:
    return keys.resolve_parts(plan, res, metric, leaf, values.read)


def by_resource(batches: DataFrame, signal: str, plan: Sequence[KeySource]) -> DataFrame:
    """Whole resources per key: (batch_id, tag, first, resources)."""
    rows = batches.repartition("batch_id").select("batch_id", F.posexplode("resources").alias("i", "r"))
    attrs, none = F.col("r.resource.attributes"), F.array().cast(values.PAIRS)
    parts = _parts(plan, attrs, F.lit(""), none)
    on_res, _ = keys.promote(plan, parts, attrs, none, values.put_if_absent)
    rows = rows.select("batch_id", "i", keys.join_parts(parts).alias("tag"), _with_attributes(F.col("r"), on_res, plan).alias("r"))
    return rows.groupBy("batch_id", "tag").agg(F.min("i").cast("long").alias("first"), _gather(F.col("i"), F.col("r")).alias("resources"))


def _with_attributes(resource: Column, attrs: Column, plan: Sequence[KeySource]) -> Column:
    if not any(k.promote and k.source == "resource" for k in plan):
        return resource
    empty = F.struct(attrs.alias("attributes"), F.lit(0).cast("long").alias("dropped_attributes_count"))
    return resource.withField("resource", F.coalesce(F.when(resource["resource"].isNotNull(), resource["resource"].withField("attributes", attrs)), empty))


def leaves(batches: DataFrame, signal: str) -> DataFrame:
    """(batch_id, i, j, k, l, r, s, x, p): items (of metrics: points) with their places, under
    resource ``r`` and scope ``s`` without what is below them. Resources and scopes without
    items are left out; a metric without points is one leaf whose point is null."""
    _, _, scopes, items = LEVELS[signal]
    rows = batches.repartition("batch_id").select("batch_id", F.posexplode("resources").alias("i", "r"))
    rows = rows.select("batch_id", "i", F.col("r").dropFields(scopes).alias("r"), F.posexplode(F.col("r")[scopes]).alias("j", "s"))
    rows = rows.select("batch_id", "i", "j", "r", F.col("s").dropFields(items).alias("s"), F.posexplode(F.col("s")[items]).alias("k", "x"))
    if signal != "metrics":
        return rows.select("*", F.lit(0).alias("l"), F.lit(None).cast("int").alias("p"))
    count = otlp.points(F.col("x"))
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array(F.lit(None).cast("int")))
    return rows.withColumn("p", F.explode(places)).withColumn("l", F.coalesce("p", F.lit(0)))


def _point(metric: Column, place: Column) -> Column:
    """The attributes of a metric's point; none for a bare shell."""
    return otlp.each_kind(metric, lambda k, d: F.try_element_at(d["data_points"], place + 1)["attributes"], F.lit(None).cast(values.PAIRS))


def by_leaf(batches: DataFrame, signal: str, plan: Sequence[KeySource]) -> DataFrame:
    """Shells rebuilt around the leaves of each key: (batch_id, tag, first, resources).

    Batches are dealt out whole, by their number, once; the nested groupings find all they
    need where they are."""
    _, _, scopes, items = LEVELS[signal]
    rows = leaves(batches, signal)
    attrs = F.col("r.resource.attributes")
    if signal == "metrics":
        own, name = F.coalesce(_point(F.col("x"), F.col("p")), F.array().cast(values.PAIRS)), F.col("x.name")
    else:
        own, name = F.coalesce(F.col("x.attributes"), F.array().cast(values.PAIRS)), F.lit("")
    parts = _parts(plan, attrs, name, own)
    on_res, on_leaf = keys.promote(plan, parts, attrs, own, values.put_if_absent)
    rows = rows.withColumns({"tag": keys.join_parts(parts), "r": _with_attributes(F.col("r"), on_res, plan), "own": on_leaf})
    if signal == "metrics":
        # points of a metric that share a key go back under one shell
        change = any(k.promote and k.source != "resource" for k in plan)
        picked = _gather(F.col("l"), F.struct(F.col("p").alias("p"), F.col("own").alias("own")))
        rows = rows.groupBy("batch_id", "tag", "i", "j", "k").agg(F.min("l").alias("l"), F.first("r").alias("r"), F.first("s").alias("s"), F.first("x").alias("x"), picked.alias("picked"))
        some = F.filter("picked", lambda y: y["p"].isNotNull())

        def take(points: Column) -> Column:
            one = lambda y: F.element_at(points, y["p"] + 1)
            return F.transform(some, (lambda y: one(y).withField("attributes", y["own"])) if change else one)

        rows = rows.withColumn("x", otlp.with_points(F.col("x"), take))
    elif any(k.promote and k.source != "resource" for k in plan):
        rows = rows.withColumn("x", F.col("x").withField("attributes", F.col("own")))
    place = F.struct("i", "j", "k", "l").alias("place")
    rows = rows.groupBy("batch_id", "tag", "i", "j").agg(F.min(place).alias("place"), F.first("r").alias("r"), F.first("s").alias("s"), _gather(F.col("k"), F.col("x")).alias("x"))
    rows = rows.withColumn("s", F.struct(F.col("s.scope"), F.col("x").alias(items), F.col("s.schema_url")))
    rows = rows.groupBy("batch_id", "tag", "i").agg(F.min("place").alias("place"), F.first("r").alias("r"), _gather(F.col("j"), F.col("s")).alias("s"))
    rows = rows.withColumn("r", F.struct(F.col("r.resource"), F.col("s").alias(scopes), F.col("r.schema_url")))
    found = rows.groupBy("batch_id", "tag").agg(F.min("place").alias("place"), _gather(F.col("i"), F.col("r")).alias("resources"))
    first = F.col("place.i").cast("long") * (1 << 40) + F.col("place.j").cast("long") * (1 << 30) + F.col("place.k").cast("long") * (1 << 15) + F.col("place.l")
    return found.select("batch_id", "tag", first.alias("first"), "resources")


def group_batches(batches: DataFrame, signal: str, plan: Sequence[KeySource] | None) -> DataFrame:
    """(batch_id, tag, first, resources): without a plan each batch is one group, a plan over
    resources alone moves them whole, any other goes down to the leaves. ``first`` orders
    the groups of a batch as the batch shows them."""
    if not plan:
        return batches.select("batch_id", F.lit("").alias("tag"), F.lit(0).cast("long").alias("first"), "resources")
    return by_resource(batches, signal, plan) if keys.resource_only(plan) else by_leaf(batches, signal, plan)


def first_seen(df: DataFrame, key: str, pos: str) -> DataFrame:
    """(key, first position, number of rows); order by ``first`` for first-seen order."""
    return df.groupBy(key).agg(F.min(pos).alias("first"), F.count("*").alias("items"))


def merge_drops(*tables: DataFrame) -> DataFrame:
    """Drop counts (reason, n) united and added up; reasons are never merged."""
    found = tables[0]
    for t in tables[1:]:
        found = found.unionByName(t)
    return found.filter("n > 0").groupBy("reason").agg(F.sum("n").alias("n"))
