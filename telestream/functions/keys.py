"""Partition keys as column expressions: plans, parts, promotion, hashes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..config import KeySource, WriterConfig, compiled

SEPARATOR = "\u001f"
Plan = tuple[KeySource, ...]


def compile_plan(config: WriterConfig) -> Plan | None:
    """The key plan; None unless records are keyed by a tag hash."""
    if config.strategy != "tag_hash":
        return None
    if config.tags:
        return tuple(KeySource(name=t) for t in config.tags)
    for i, k in enumerate(config.keys):
        compiled(k.regex, i)
    return tuple(KeySource(k.source or "resource", k.name, k.regex, k.promote) for k in config.keys)


def resource_only(plan: Sequence[KeySource]) -> bool:
    """Whether blocks can be grouped whole, before leaves are unnested."""
    return all(k.source == "resource" for k in plan)


def promotes(plan: Sequence[KeySource]) -> bool:
    return any(k.promote for k in plan)


def first_capture(value: Column, pattern: str) -> Column:
    """Group 1 of the first match, the whole match of a pattern without groups, else ''."""
    return F.regexp_extract(value, pattern, 1 if compiled(pattern).groups else 0)


def attribute(attrs: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(attrs, F.lit(name)), F.lit(""))


def resolve_parts(plan: Sequence[KeySource], res: Column, metric: Column, leaf: Column, read: Callable[[Column, str], Column] = attribute) -> list[Column]:
    """One string per component; what is missing is empty. ``read`` gives the text under a
    key of attributes, which are string maps or (``values.read``) lists of typed values."""
    from_ = {"resource": lambda k: read(res, k.name), "datapoint": lambda k: read(leaf, k.name), "metric_name": lambda k: F.coalesce(metric, F.lit(""))}
    found = [from_[k.source](k) for k in plan]
    return [first_capture(v, k.regex) if k.regex else v for k, v in zip(plan, found)]


def join_parts(parts: Sequence[Column]) -> Column:
    return F.concat_ws(SEPARATOR, *parts) if parts else F.lit("")


def put_if_absent(attrs: Column, name: str, value: Column) -> Column:
    add = (value != "") & ~F.map_contains_key(attrs, F.lit(name))
    return F.when(add, F.map_concat(attrs, F.create_map(F.lit(name), value))).otherwise(attrs)


def promote(plan: Sequence[KeySource], parts: Sequence[Column], res: Column, leaf: Column, put: Callable[[Column, str, Column], Column] = put_if_absent) -> tuple[Column, Column]:
    """Resource and leaf attributes with parts written back; later parts see earlier ones."""
    for k, part in zip(plan, parts):
        if k.promote and k.source == "resource":
            res = put(res, k.promote, part)
        elif k.promote:
            leaf = put(leaf, k.promote, part)
    return res, leaf


def xxh64(value: Column) -> Column:
    """XXH64 with seed 0 of a string's bytes, as a long.

    The SQL function is fixed at seed 42, so Catalyst's own expression is built with the
    seed; it stays inside whole-stage code generation. Classic sessions only.
    """
    jvm = SparkSession.getActiveSession()._jvm
    tools = jvm.org.apache.spark.sql.classic.ExpressionUtils
    children = jvm.PythonUtils.toSeq([tools.expression(value._jc)])
    return Column(tools.column(jvm.org.apache.spark.sql.catalyst.expressions.XxHash64(children, 0)))


def partition_key(joined: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(xxh64(joined))), 16, "0")


def random_key() -> Column:
    return F.uuid()


def fnv1a32(value: Column) -> Column:
    """FNV-1a over the UTF-8 bytes, in 64-bit arithmetic."""
    digits = F.hex(F.encode(value, "utf-8"))
    places = F.when(F.length(digits) > 0, F.sequence(F.lit(1), F.length(digits), F.lit(2))).otherwise(F.array().cast("array<int>"))
    step = lambda h, i: (h.bitwiseXOR(F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("long")) * 16777619) % 4294967296
    return F.aggregate(places, F.lit(2166136261).cast("long"), step)
