"""String helpers: clamping at code points, prefixes, display forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8_cut(value: Column, most: int) -> Column:
    """The longest prefix of at most ``most`` bytes that ends between code points.

    Looks back over at most four places; with none left the result is empty, so it is
    always valid UTF-8. Values within the bound are left alone.
    """
    data = F.encode(value, "utf-8")
    at = lambda k: F.conv(F.hex(F.substring(data, k + 1, 1)), 16, 10).cast("int")
    cut = F.lit(0)
    for k in range(max(1, most - 3), most + 1):  # the largest place that fits is tested first
        cut = F.when(at(k).bitwiseAND(0xC0) != 0x80, F.lit(k)).otherwise(cut)
    return F.when(F.octet_length(value) <= most, value).otherwise(F.decode(F.substring(data, F.lit(1), cut), "utf-8"))


def clamp_map(attrs: Column, most: int) -> tuple[Column, Column]:
    """String attributes cut to ``most`` bytes, and how many were."""
    long = F.size(F.map_filter(attrs, lambda k, v: F.octet_length(v) > most))
    return F.transform_values(attrs, lambda k, v: utf8_cut(v, most)), long


def namespace_of(name: Column) -> Column:
    return F.when(F.instr(name, "_") > 1, F.substring_index(name, "_", 1)).otherwise(name)


def base64_line(data: Column) -> Column:
    """Base64 on one line."""
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def fixed(x: Column, digits: int) -> Column:
    """A double with so many decimals, rounded as the exact binary value is, ties to even
    digits: in whole numbers, for Java's formatter rounds the shortest decimal form instead,
    which is another number. The whole part and the 52 binary places after it are longs; only
    a double below 1 has bits beyond those, which break ties. From 2^63 a double is whole; from
    1e37, and for what is no number, Java's formatter is left."""
    size, tens, unit = F.abs(x), 10**digits, 1 << 52
    near = F.when(size < float(1 << 63), size).otherwise(0.0)
    whole = F.floor(near).cast("long")
    places = (near - F.floor(near)) * float(unit)
    made = places.cast("long") * F.lit(tens).cast("long")
    last, rest = F.shiftright(made, 52), made.bitwiseAND(F.lit(unit - 1))
    odd = (last if digits else whole) % 2 == 1
    up = (rest > unit // 2) | ((rest == unit // 2) & (odd | (places > F.floor(places))))
    last = last + F.when(up, F.lit(1)).otherwise(F.lit(0))
    head = (whole + F.when(last >= (tens if digits else 1), F.lit(1)).otherwise(F.lit(0))).cast("string")
    point = lambda head, tail: head if not digits else F.concat(head, F.lit("."), F.lpad(tail, digits, "0"))
    # high * 2^62 + rest, both exact
    vast = F.when((size >= float(1 << 63)) & (size < 1e37), size).otherwise(0.0)
    high, whole19 = F.floor(vast / float(1 << 62)), lambda c: c.cast("decimal(19,0)")
    large = whole19(high) * whole19(F.lit(1 << 62)) + whole19((vast - high.cast("double") * float(1 << 62)).cast("long"))
    shown = F.when(size < float(1 << 63), point(head, (last % tens).cast("string"))).when(size < 1e37, point(large.cast("string"), F.lit("0"))).otherwise(F.format_string(f"%.{digits}f", size))
    return F.when(x < 0, F.concat(F.lit("-"), shown)).otherwise(shown)


def show_ns(x: Column) -> Column:
    unit = lambda by, digits, name: F.concat(fixed(x / by, digits), F.lit(name))
    large = F.concat(fixed(x / F.when(x < 1e9, 1e6).otherwise(1e9), 2), F.when(x < 1e9, "ms").otherwise("s"))
    return F.when(x.isNull(), "—").when(x < 1e3, unit(1.0, 0, "ns")).when(x < 1e6, unit(1e3, 1, "µs")).otherwise(large)


def show_bytes(x: Column) -> Column:
    return F.when(x.isNull(), "—").when(x < 1024, F.format_string("%dB", x.cast("long"))).when(x < 1 << 20, F.concat(fixed(x / 1024, 1), F.lit("KiB"))).otherwise(F.concat(fixed(x / (1 << 20), 2), F.lit("MiB")))


def show_ratio(x: Column) -> Column:
    return F.when(x.isNull(), "—").otherwise(F.concat(fixed(x, 2), F.lit("×")))


def show_per_record(x: Column) -> Column:
    return F.when(x.isNull(), "—").when(x < 10, F.concat(fixed(x, 2), F.lit("B"))).when(x < 1024, F.concat(fixed(x, 0), F.lit("B"))).otherwise(F.concat(fixed(x / 1024, 1), F.lit("KiB")))


def to_int(value: Column, default: int) -> Column:
    return F.coalesce(value.try_cast("long"), F.lit(default))
