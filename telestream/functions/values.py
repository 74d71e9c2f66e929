"""Attribute values of every kind, and lists of them, as column expressions.

A value is a struct with a field per kind (``sources.model``); attributes are an array of
(key, value). The text of a value is what keys are made of.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.model import struct_ddl
from .text import base64_line, utf8_cut

VALUE = struct_ddl("AnyValue")
PAIRS = f"array<struct<key: string, value: {VALUE}>>"


def text_value(text: Column) -> Column:
    """A string as a value."""
    none = lambda kind: F.lit(None).cast(kind)
    return F.struct(text.alias("string_value"), none("boolean").alias("bool_value"), none("bigint").alias("int_value"), none("double").alias("double_value"), none("string").alias("array_value"), none("string").alias("kvlist_value"), none("binary").alias("bytes_value"))


def pair(key: str, value: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), value.alias("value"))


def int_value(number: Column) -> Column:
    return text_value(F.lit(None).cast("string")).withField("int_value", number.cast("bigint"))


def from_map(attrs: Column) -> Column:
    """Attributes from a string map."""
    return F.transform(F.map_entries(attrs), lambda e: F.struct(e["key"].alias("key"), text_value(e["value"]).alias("value")))


def number_text(x: Column) -> Column:
    """A double in the shortest digits that give it back: without exponent between 1e-6 and
    1e21, else with one; whole numbers have no point."""
    raw = F.upper(x.cast("string"))
    digits, power = F.regexp_replace(F.regexp_extract(raw, r"^(-?[\d.]+)", 1), r"\.0$", ""), F.regexp_extract(raw, r"E(-?\d+)$", 1)
    short = F.regexp_replace(raw, r"\.0$", "")
    long = F.concat(digits, F.lit("e"), F.when(power.startswith("-"), "-").otherwise("+"), F.regexp_replace(power, "-", ""))
    size = F.abs(x)
    # between 1e-6 and 1e-3, and from 1e7, Java writes an exponent: shift the point by hand
    small = F.concat(F.when(x < 0, "-").otherwise(""), F.lit("0."), F.repeat(F.lit("0"), -power.try_cast("int") - 1), F.regexp_replace(F.regexp_replace(digits, "-", ""), r"\.", ""))
    whole = F.regexp_replace(F.regexp_replace(digits, "-", ""), r"\.", "")
    point = power.try_cast("int") + 1
    large = F.concat(F.when(x < 0, "-").otherwise(""), F.when(F.length(whole) <= point, F.rpad(whole, point, "0")).otherwise(F.concat(F.substring(whole, F.lit(1), point), F.lit("."), F.substring(whole, point + 1, F.length(whole)))))
    shown = F.when(power == "", short).when((size >= 1e-6) & (size < 1), small).when((size >= 1) & (size < 1e21), large).otherwise(long)
    odd = lambda name: F.lit(f"json: unsupported value: {name}")
    return F.when(F.isnan(x), odd("NaN")).when(x == float("inf"), odd("+Inf")).when(x == float("-inf"), odd("-Inf")).when(x == 0, "0").otherwise(shown)


def as_string(value: Column) -> Column:
    """The text of a value: strings as they are, numbers and truth values in digits and
    letters, bytes in Base64, lists and maps as their JSON; '' for none."""
    return F.coalesce(value["string_value"], value["bool_value"].cast("string"), value["int_value"].cast("string"), number_text(value["double_value"]), base64_line(value["bytes_value"]), _plain_json(value["array_value"]), _plain_json(value["kvlist_value"]), F.lit(""))


def _plain_json(text: Column) -> Column:
    """A list's or map's JSON without the wrapping of each value, where its values are plain."""
    values = F.from_json(text, "values array<struct<key: string, stringValue: string, intValue: string, boolValue: boolean, doubleValue: double, value: struct<stringValue: string, intValue: string, boolValue: boolean, doubleValue: double>>>")["values"]
    shown = lambda v: F.coalesce(F.when(v["stringValue"].isNotNull(), F.concat(F.lit('"'), F.regexp_replace(v["stringValue"], r'(["\\])', r"\\$1"), F.lit('"'))), v["intValue"], v["boolValue"].cast("string"), number_text(v["doubleValue"]), F.lit("null"))
    items = F.array_join(F.transform(values, shown), ",")
    entries = F.array_join(F.transform(F.array_sort(values, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)), lambda v: F.concat(F.lit('"'), v["key"], F.lit('":'), shown(v["value"]))), ",")
    is_map = F.exists(values, lambda v: v["key"].isNotNull())
    return F.when(text.isNotNull(), F.when(is_map, F.concat(F.lit("{"), entries, F.lit("}"))).otherwise(F.concat(F.lit("["), F.coalesce(items, F.lit("")), F.lit("]"))))


def get(attrs: Column, name: str) -> Column:
    """The value under a key (the first one); null if there is none."""
    return F.try_element_at(F.filter(F.coalesce(attrs, F.array().cast(PAIRS)), lambda a: a["key"] == name), F.lit(1))["value"]


def read(attrs: Column, name: str) -> Column:
    """The text under a key, '' if there is none."""
    return F.coalesce(as_string(get(attrs, name)), F.lit(""))


def put_if_absent(attrs: Column, name: str, text: Column) -> Column:
    attrs = F.coalesce(attrs, F.array().cast(PAIRS))
    add = (text != "") & ~F.exists(attrs, lambda a: a["key"] == name)
    return F.when(add, F.concat(attrs, F.array(pair(name, text_value(text))).cast(PAIRS))).otherwise(attrs)


def clamp(attrs: Column, most: int) -> Column:
    """String values cut to ``most`` bytes; all other kinds are left alone."""
    return F.transform(attrs, lambda a: a.withField("value", F.when(F.octet_length(a["value"]["string_value"]) > most, a["value"].withField("string_value", utf8_cut(a["value"]["string_value"], most))).otherwise(a["value"])))


def clamped(attrs: Column, most: int) -> Column:
    """How many values ``clamp`` changes."""
    return F.coalesce(F.size(F.filter(attrs, lambda a: F.octet_length(a["value"]["string_value"]) > most)), F.lit(0))
