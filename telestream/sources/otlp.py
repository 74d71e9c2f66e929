"""Wire encodings of a batch, OTLP JSON and OTLP protobuf, as Arrow functions of columns.

A batch is one row with a ``resources`` column of the type ``nested(signal)``: the whole
model of the protocol, every kind of value, point and attribute list. In JSON, ids are
hexadecimal, 64-bit integers are strings, and fields that hold their default are left out.
Unknown fields are skipped by both readers; what cannot be read gives null, or an error
where ``strict``. The work is in ``columnar``; built-in expressions over lists of lists are
interpreted value by value and take several times as long (README).
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ENCODINGS, ConfigError
from . import columnar
from .model import DEFAULTS, LEVELS, MESSAGES, METRIC_KINDS, TEMPORAL, ddl, field_ddl, parts

nested = ddl


def build(message: str, **given: Column) -> Column:
    """A message of the model: what is not given is its default, or absent."""
    fields = []
    for field, (_, kind) in MESSAGES[message].items():
        many, mark, inner = parts(kind)
        v = given.pop(field, None)
        if v is None:
            v = F.array() if many else F.lit(None) if mark or inner in MESSAGES else F.lit(DEFAULTS[inner])
        fields.append(v.cast(field_ddl(kind)).alias(field))
    if given:
        raise ValueError(f"{message} has no field {', '.join(given)}")
    return F.struct(*fields)


def to_wire(signal: str, encoding: str, resources: Column) -> Column:
    def run(x: pa.Array) -> pa.Array:
        return columnar.encode(signal, encoding, x)

    return F.arrow_udf(run, "binary")(resources)


def from_wire(signal: str, encoding: str, data: Column, strict: bool = False) -> Column:
    """The resources; without ``strict`` null where the bytes are no such payload."""

    def run(x: pa.Array) -> pa.Array:
        return columnar.decode(signal, encoding, x, strict)

    return F.arrow_udf(run, ddl(signal))(data)


def to_otlp_json(signal: str, resources: Column) -> Column:
    return to_wire(signal, "otlp_json", resources).cast("string")


def from_otlp_json(signal: str, text: Column) -> Column:
    """The resources; null where the text is no such document."""
    return from_wire(signal, "otlp_json", text.cast("binary"))


def _known(signal: str, encoding: str) -> None:
    if encoding not in ENCODINGS or signal not in LEVELS:
        raise ConfigError(f"unknown encoding {encoding!r} of {signal!r}; known: {', '.join(ENCODINGS)}")


def encoder(signal: str, encoding: str) -> Callable[[Column], Column]:
    _known(signal, encoding)
    return lambda c: to_wire(signal, encoding, c)


def decoder(signal: str, encoding: str) -> Callable[[Column], Column]:
    _known(signal, encoding)
    return lambda c: from_wire(signal, encoding, c)


# --- walks over a batch ------------------------------------------------------------------
def each_kind(metric: Column, made: Callable[[str, Column], Column], none: Column) -> Column:
    """``made(kind, data)`` of the kind that a metric has, ``none`` for a bare shell."""
    out = none
    for kind in reversed(METRIC_KINDS):
        out = F.when(metric[kind].isNotNull(), made(kind, metric[kind])).otherwise(out)
    return out


def points(metric: Column) -> Column:
    """The number of a metric's points, whatever its kind."""
    return each_kind(metric, lambda k, d: F.coalesce(F.size(d["data_points"]), F.lit(0)), F.lit(0))


def kind_of(metric: Column) -> Column:
    return each_kind(metric, lambda k, d: F.lit(k), F.lit("empty"))


def temporality(metric: Column) -> Column:
    return each_kind(metric, lambda k, d: d["aggregation_temporality"] if k in TEMPORAL else F.lit(0), F.lit(0))


def with_points(metric: Column, change: Callable[[Column], Column]) -> Column:
    """The metric with its points changed, and all of its shell as it was."""
    return with_kinds(metric, lambda kind, data: data.withField("data_points", change(data["data_points"])))


def with_kinds(metric: Column, change: Callable[[str, Column], Column]) -> Column:
    """The metric with the data of each kind changed; every change reads the metric as it was,
    for expressions that read each other's results double with each of them."""
    kinds = {k: F.when(metric[k].isNotNull(), change(k, metric[k])) for k in METRIC_KINDS}
    return F.struct(*[(kinds[f] if f in kinds else metric[f]).alias(f) for f in MESSAGES["Metric"]])


def read_jsonl(lines: DataFrame, signal: str, column: str = "value") -> DataFrame:
    """(resources) of the lines of a JSON-lines file; blank and cut-off lines are skipped."""
    rows = lines.filter(F.trim(column) != "").select(from_otlp_json(signal, F.col(column)).alias("resources"))
    return rows.filter("resources IS NOT NULL")
