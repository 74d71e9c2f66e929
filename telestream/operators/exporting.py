"""The write path: group, key, encode, recover, chunk, send.

Batches are rows of (batch_id, resources). Each batch is grouped by the key plan, a group's
payload is tried as it is and then through the policies, and payloads go into requests in
the order in which their batch shows the groups. Payloads are measured as they are shipped,
encoded and compressed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import REJECT, SPLIT, TRUNCATE, WriterConfig
from ..functions import keys, values
from ..packaging import written
from ..sources import codecs, otlp
from ..sources.model import LEVELS
from .grouping import group_batches
from .oversize import DEEP, WHOLE
from .sending import chunk_requests

FIELDS = ["batch_id", "tag", "first", "partition_key", "path", "resources"]
MARSHAL, COMPRESS, REJECTED, EXHAUSTED = "marshal_error", "compress_error", "reject_policy", "chain_exhausted"


def _total(items: Column, count: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0), lambda n, x: n + count(x))


def item_count(signal: str, resources: Column) -> Column:
    """Spans, log records, or datapoints of a batch."""
    _, _, scopes, items = LEVELS[signal]
    leaf = (lambda s: _total(s[items], otlp.points)) if signal == "metrics" else (lambda s: F.size(s[items]))
    return _total(resources, lambda r: _total(r[scopes], leaf))


def _part(signal: str, resource: Column, lo: Column, hi: Column) -> Column:
    """The resource with items lo..hi of all its scopes in order, without empty scopes."""
    _, _, scopes, items = LEVELS[signal]
    own = resource[scopes]
    starts = F.aggregate(own, F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + F.size(s[items]))))

    def cut(s: Column, i: Column) -> Column:
        start, n = F.element_at(starts, i + 1), F.size(s[items])
        first = F.least(F.greatest(lo - start, F.lit(0)), n)
        last = F.least(F.greatest(hi - start, F.lit(0)), n)
        return s.withField(items, F.slice(s[items], first + 1, last - first))

    return resource.withField(scopes, F.filter(F.transform(own, cut), lambda s: F.size(s[items]) > 0))


def halves(signal: str, resources: Column) -> tuple[Column, Column, Column]:
    """(can be halved, left, right): at the resources if there are several, else at the
    items of the one, else (metrics) at the points of its one metric, whose shell both
    halves have."""
    _, _, scopes, items = LEVELS[signal]
    n = F.size(resources)
    mid = F.floor(n / 2).cast("int")
    one = F.try_element_at(resources, F.lit(1))
    k = F.when(n == 1, _total(one[scopes], lambda s: F.size(s[items]))).otherwise(0)
    half = F.floor(k / 2).cast("int")
    left = F.when(n > 1, F.slice(resources, F.lit(1), mid)).when(k > 1, F.array(_part(signal, one, F.lit(0), half)))
    right = F.when(n > 1, F.slice(resources, mid + 1, n - mid)).when(k > 1, F.array(_part(signal, one, half, k)))
    can = (n > 1) | (k > 1)
    if signal == "metrics":
        points = F.when(k == 1, _total(one[scopes], lambda s: _total(s[items], otlp.points))).otherwise(0)
        cut = F.floor(points / 2).cast("int")

        def some(first: Column, length: Column) -> Column:
            metric = lambda m: otlp.with_points(m, lambda p: F.slice(p, first, length))
            kept = F.filter(one[scopes], lambda s: F.size(s[items]) > 0)
            return F.array(one.withField(scopes, F.transform(kept, lambda s: s.withField(items, F.transform(s[items], metric)))))

        left, right, can = left.when(points > 1, some(F.lit(1), cut)), right.when(points > 1, some(cut + 1, points - cut)), can | (points > 1)
    return can, left, right


def _leaf_lists(signal: str) -> tuple[Callable, Callable]:
    """(change, count) of an item's attribute lists; bodies of log records are no attributes."""
    if signal == "logs":
        return (lambda x, cut: x.withField("attributes", cut(x["attributes"]))), (lambda x, n: n(x["attributes"]))
    if signal == "traces":
        inner = lambda items, cut: F.transform(items, lambda e: e.withField("attributes", cut(e["attributes"])))
        count = lambda items, n: _total(items, lambda e: n(e["attributes"]))
        return (
            lambda x, cut: x.withField("attributes", cut(x["attributes"])).withField("events", inner(x["events"], cut)).withField("links", inner(x["links"], cut)),
            lambda x, n: n(x["attributes"]) + F.coalesce(count(x["events"], n), F.lit(0)) + F.coalesce(count(x["links"], n), F.lit(0)),
        )

    # a summary's points have no exemplars; all other kinds do
    def change(m: Column, cut: Callable) -> Column:
        def exemplar(e: Column) -> Column:
            return e.withField("filtered_attributes", cut(e["filtered_attributes"]))

        def plain(p: Column) -> Column:
            return p.withField("attributes", cut(p["attributes"]))

        def full(p: Column) -> Column:
            return plain(p).withField("exemplars", F.transform(p["exemplars"], exemplar))

        return otlp.with_kinds(m, lambda kind, data: data.withField("data_points", _apply(data["data_points"], plain if kind == "summary" else full)))

    def count_(m: Column, n: Callable) -> Column:
        def of(kind: str, data: Column) -> Column:
            one = lambda p: n(p["attributes"]) + (F.lit(0) if kind == "summary" else F.coalesce(_total(p["exemplars"], lambda e: n(e["filtered_attributes"])), F.lit(0)))
            return F.coalesce(_total(data["data_points"], one), F.lit(0))

        return otlp.each_kind(m, of, F.lit(0))

    return change, count_


def _apply(items: Column, change: Callable[[Column], Column]) -> Column:
    return F.transform(items, lambda x: change(x))


def truncate(signal: str, resources: Column, most: int) -> tuple[Column, Column]:
    """String attributes cut to ``most`` bytes at every level that has attributes, and how
    many were: resources, scopes, items, and the events, links, points and exemplars below."""
    _, _, scopes, items = LEVELS[signal]
    cut, count = (lambda a: values.clamp(a, most)), (lambda a: values.clamped(a, most))
    change, number = _leaf_lists(signal)
    own = lambda x, field: x.withField(field, F.when(x[field].isNotNull(), x[field].withField("attributes", cut(x[field]["attributes"]))))
    scope = lambda s: own(s, "scope").withField(items, F.transform(s[items], lambda x: change(x, cut)))
    made = F.transform(resources, lambda r: own(r, "resource").withField(scopes, F.transform(r[scopes], scope)))
    of_scope = lambda s: count(s["scope"]["attributes"]) + _total(s[items], lambda x: number(x, count))
    n = _total(resources, lambda r: count(r["resource"]["attributes"]) + _total(r[scopes], of_scope))
    return made, n


@dataclass(frozen=True)
class Packed:
    """``payloads``: (batch_id, tag, first, partition_key, path, data, items); ``drops``:
    (batch_id, reason, n); ``clamped``: (batch_id, n) attributes cut."""

    payloads: DataFrame
    drops: DataFrame
    clamped: DataFrame


def pack(groups: DataFrame, signal: str, config: WriterConfig) -> Packed:
    """Every group is tried unmodified first. What does not fit goes on through the policies
    in rounds, each written once; a group costs as many encodings as it has pieces. ``path``
    orders the pieces of a group, left halves first. What cannot be encoded or compressed is
    dropped with a reason of its own, unless it is a clamped form, whose original goes on."""
    spark = groups.sparkSession
    marshal, squeeze = otlp.encoder(signal, config.encoding), codecs.compressor(config.compression)
    count = item_count(signal, F.col("resources")).cast("long")
    shipped, drops, clamps = [], [], []

    def attempt(df: DataFrame) -> DataFrame:
        raw = df.withColumn("raw", marshal(F.col("resources")))
        data = raw.withColumn("data", squeeze(F.col("raw")))
        reason = F.when(F.col("raw").isNull(), MARSHAL).when(F.col("data").isNull(), COMPRESS)
        fits = F.coalesce(F.length("data") <= config.max_record_size, F.lit(False))
        # what fits needs its rows no more, what does not fit needs no payload
        made = data.select(*df.columns, F.when(fits, F.col("data")).alias("data"), fits.alias("fits"), reason.alias("reason"), count.alias("items"))
        made = written(spark, made.withColumn("resources", F.when(~F.col("fits"), F.col("resources"))), "attempt")
        shipped.append(made.filter("fits").select(*FIELDS[:-1], "data", "items"))
        return made.filter(~F.col("fits"))

    def lose(df: DataFrame, reason: Column) -> None:
        drops.append(df.select("batch_id", reason.alias("reason"), F.col("items").alias("n")))

    over = attempt(groups.withColumn("path", F.lit("")).select(*FIELDS))
    lose(over.filter("reason IS NOT NULL"), F.col("reason"))
    over = over.filter("reason IS NULL")
    for policy in config.policies:
        if policy == TRUNCATE:
            made, n = truncate(signal, F.col("resources"), config.max_attribute_value_bytes)
            cut = over.withColumns({"clamped": n.cast("long"), "before": F.col("resources")}).withColumn("resources", F.when(F.col("clamped") > 0, made).otherwise(F.col("resources")))
            clamps.append(cut.filter("clamped > 0").select("batch_id", F.col("clamped").alias("n")))
            same = cut.filter("clamped = 0").select(*FIELDS, "items")
            left = attempt(cut.filter("clamped > 0").select(*FIELDS, "before"))
            left = left.withColumn("resources", F.when(F.col("reason").isNull(), F.col("resources")).otherwise(F.col("before")))
            over = same.unionByName(left.select(*FIELDS, "items"))
        elif policy == REJECT:
            lose(over, F.lit(REJECTED))
            over = None
        elif policy == SPLIT:
            for depth in range(config.max_attempts + 1):
                if not depth:
                    left = over
                if depth == config.max_attempts:
                    lose(left, F.lit(DEEP))
                    break
                can, one, two = halves(signal, F.col("resources"))
                lose(left.filter(~can), F.lit(WHOLE))
                parts = F.explode(F.array(F.struct(F.concat("path", F.lit("0")).alias("path"), one.alias("resources")), F.struct(F.concat("path", F.lit("1")).alias("path"), two.alias("resources"))))
                pieces = left.filter(can).select(*FIELDS[:4], parts.alias("p")).select(*FIELDS[:4], "p.path", "p.resources")
                left = attempt(pieces)
                lose(left.filter("reason IS NOT NULL"), F.col("reason"))
                left = left.filter("reason IS NULL")
                if left.isEmpty():
                    break
            over = None
    if over is not None:
        lose(over, F.lit(EXHAUSTED))

    def united(tables: list[DataFrame]) -> DataFrame:
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    lost = united(drops).groupBy("batch_id", "reason").agg(F.sum("n").alias("n")).filter("n > 0")
    none = groups.select("batch_id", F.lit(0).cast("long").alias("n")).limit(0)
    cut = united([none, *clamps]).groupBy("batch_id").agg(F.sum("n").alias("n"))
    return Packed(united(shipped), lost, cut)


@dataclass(frozen=True)
class Exported:
    """What ``pack`` gives, and ``requests``: (batch_id, chunk, n, bytes)."""

    records: DataFrame
    requests: DataFrame
    drops: DataFrame
    clamped: DataFrame


def export(batches: DataFrame, signal: str, config: WriterConfig) -> Exported:
    """The whole write path of (batch_id, resources). A random key is drawn once per group
    and shared by its payloads."""
    config.validate()
    groups = group_batches(batches, signal, keys.compile_plan(config))
    key = keys.partition_key(F.col("tag")) if config.strategy == "tag_hash" else keys.random_key()
    groups = groups.withColumn("partition_key", key)
    if config.strategy != "tag_hash":
        groups = written(batches.sparkSession, groups, "groups")
    packed = pack(groups, signal, config)
    entries = packed.payloads.select("batch_id", F.struct("first", "path").alias("place"), F.length("data").alias("bytes"))
    return Exported(packed.payloads, chunk_requests(entries, "batch_id", "place", "bytes", config.max_records, config.max_bytes), packed.drops, packed.clamped)


def export_traces(batches: DataFrame, config: WriterConfig) -> Exported:
    return export(batches, "traces", config)


def export_metrics(batches: DataFrame, config: WriterConfig) -> Exported:
    return export(batches, "metrics", config)


def export_logs(batches: DataFrame, config: WriterConfig) -> Exported:
    return export(batches, "logs", config)


def writer_figures(exported: Exported) -> DataFrame:
    """(name, reason, n): the writer's counters and the sums behind its three histograms of
    requests (records, bytes, and the requests themselves)."""
    drops = exported.drops.groupBy("reason").agg(F.sum("n").alias("n")).select(F.lit("records_dropped").alias("name"), "reason", "n")
    clamped = exported.clamped.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("attributes_truncated").alias("name"), F.lit("").alias("reason"), "n")
    put = exported.requests.agg(F.count("*").alias("put_requests"), F.coalesce(F.sum("n"), F.lit(0)).alias("put_records"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("put_bytes"))
    put = put.select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit("").alias("reason"), F.col(k).cast("long").alias("n")) for k in ("put_requests", "put_records", "put_bytes")])).alias("x")).select("x.*")
    return drops.unionByName(clamped).unionByName(put)
