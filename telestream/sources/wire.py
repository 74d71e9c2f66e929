"""The protobuf wire form of the model.

With the protobuf runtime, messages are built from and read into it; its classes are made
from the same table of fields. Without it, a plain writer and reader of the wire form do.
Both take and give rows as Arrow hands them out: dicts with the model's field names.
"""

from __future__ import annotations

import base64
import json
import struct
from functools import cache

from .model import DEFAULTS, LEVELS, MESSAGES, NESTED, camel, parts

PACKAGE = "telemetry"
_TOP = 1 << 63


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= _TOP else n


# --- values inside values, as the protocol's JSON -----------------------------------------
def value_json(value: dict) -> dict:
    """A value's JSON form from its fields (nested ones are JSON forms already)."""
    for f, v in value.items():
        if v is not None:
            return {camel(f): str(v) if f == "int_value" else base64.b64encode(v).decode() if f == "bytes_value" else json.loads(v) if f in ("array_value", "kvlist_value") and isinstance(v, str) else v}
    return {}


def json_value(doc: dict) -> dict:
    """The fields of a value's JSON form; nested ones stay JSON text."""
    out: dict = {}
    for f in MESSAGES["AnyValue"]:
        v = doc.get(camel(f))
        if v is not None:
            out[f] = int(v) if f == "int_value" else base64.b64decode(v) if f == "bytes_value" else float(v) if f == "double_value" else json.dumps(v, separators=(",", ":")) if f in ("array_value", "kvlist_value") else v
    return out


# --- the plain form ---------------------------------------------------------------------
def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _scalar(kind: str, v) -> tuple[int, bytes]:
    """(wire type, bytes) of a scalar."""
    if kind in ("string", "bytes"):
        data = v.encode() if kind == "string" else bytes(v)
        return 2, _varint(len(data)) + data
    if kind == "double":
        return 1, struct.pack("<d", v)
    if kind in ("fixed64", "sfixed64"):
        return 1, struct.pack("<Q", v & ((1 << 64) - 1))
    if kind == "fixed32":
        return 5, struct.pack("<I", v)
    if kind == "sint32":
        return 0, _varint(v << 1 ^ v >> 31)
    return 0, _varint(int(v))


def encode_message(name: str, value: dict) -> bytes:
    """Fields in the order of their numbers, scalars that are their default left out."""
    out = []
    for field, (number, kind) in sorted(MESSAGES[name].items(), key=lambda x: x[1][0]):
        many, mark, inner = parts(kind)
        v = value.get(field)
        if v is None or many and not len(v):
            continue
        if inner in MESSAGES:
            for x in v if many else [v]:
                if inner in NESTED and isinstance(x, str):
                    x = _nested(inner, json.loads(x))
                data = encode_message(inner, x)
                out.append(_varint(number << 3 | 2) + _varint(len(data)) + data)
        elif many:  # repeated numbers are packed
            data = b"".join(_scalar(inner, x)[1] for x in v)
            out.append(_varint(number << 3 | 2) + _varint(len(data)) + data)
        elif mark or v != DEFAULTS[inner] or inner == "double" and struct.pack("<d", v) != bytes(8):
            wire, data = _scalar(inner, v)
            out.append(_varint(number << 3 | wire) + data)
    return b"".join(out)


def _nested(message: str, doc: dict) -> dict:
    rows = doc.get("values") or []
    if message == "ArrayValue":
        return {"values": [json_value(x) for x in rows]}
    return {"values": [{"key": x.get("key", ""), "value": json_value(x["value"]) if "value" in x else None} for x in rows]}


def _read(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("a number ends early")
        b = data[at]
        n |= (b & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if b < 0x80:
            return n, at


def _fields(data: bytes):
    at = 0
    while at < len(data):
        tag, at = _read(data, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            v, at = _read(data, at)
        else:
            if wire == 2:
                n, at = _read(data, at)
            elif wire in (1, 5):
                n = 8 if wire == 1 else 4
            else:
                raise ValueError(f"unknown wire type {wire}")
            v, at = data[at : at + n], at + n
            if len(v) != n:
                raise ValueError("a message ends early")
        yield number, wire, v


def _number(kind: str, v):
    if isinstance(v, bytes):
        if kind == "double":
            return struct.unpack("<d", v)[0]
        n = int.from_bytes(v, "little")
        return _signed(n) if len(v) == 8 else n
    if kind == "sint32":
        return v >> 1 ^ -(v & 1)
    return bool(v) if kind == "bool" else (v & 0xFFFFFFFF) - ((v & 0x80000000) << 1) if kind == "enum" else _signed(v)


_PACKED = {"double": 8, "fixed64": 8}


def decode_message(name: str, data: bytes, deep: bool = False) -> dict:
    spec = {n: (f, k) for f, (n, k) in MESSAGES[name].items()}
    out: dict = {}
    for f, (_, k) in MESSAGES[name].items():
        many, mark, inner = parts(k)
        out[f] = [] if many else None if mark or inner in MESSAGES else DEFAULTS[inner]
    for number, wire, v in _fields(data):
        if number not in spec:
            continue
        field, kind = spec[number]
        many, mark, inner = parts(kind)
        if (wire == 2) != (inner in MESSAGES or inner in ("string", "bytes") or many):
            raise ValueError(f"{name}.{field} has a wrong wire type")
        if mark == "|":
            for f, (_, k) in MESSAGES[name].items():
                if k[0] == "|":
                    out[f] = None
        if inner in MESSAGES:
            made = decode_message(inner, v, deep or inner in NESTED)
            if inner in NESTED:
                doc = {"values": [value_json(x) if inner == "ArrayValue" else {"key": x["key"]} | ({"value": value_json(x["value"])} if x["value"] is not None else {}) for x in made["values"]]}
                made = json.dumps(doc, separators=(",", ":"))
            if many:
                out[field].append(made)
            else:
                out[field] = made
        elif inner in ("string", "bytes"):
            out[field] = v.decode() if inner == "string" else bytes(v)
        elif many:
            if inner in _PACKED:
                if len(v) % 8:
                    raise ValueError("packed numbers end early")
                out[field] += [_number(inner, v[i : i + 8]) for i in range(0, len(v), 8)]
            else:
                at = 0
                while at < len(v):
                    n, at = _read(v, at)
                    out[field].append(_number(inner, n))
        else:
            out[field] = _number(inner, v)
    return out


# --- by the runtime ---------------------------------------------------------------------
@cache
def classes() -> dict | None:
    """Message classes of the runtime by name; None where it is not installed."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError:
        return None
    types = descriptor_pb2.FieldDescriptorProto
    kinds = {k: getattr(types, f"TYPE_{k.upper()}") for k in DEFAULTS} | {"enum": types.TYPE_INT32}
    file = descriptor_pb2.FileDescriptorProto(name="telemetry.proto", package=PACKAGE, syntax="proto3")
    for name, fields in MESSAGES.items():
        m = file.message_type.add(name=name)
        if any(k[0] == "|" for _, k in fields.values()):
            m.oneof_decl.add(name="one")
        for field, (number, kind) in fields.items():
            many, mark, inner = parts(kind)
            f = m.field.add(name=field, number=number, label=types.LABEL_REPEATED if many else types.LABEL_OPTIONAL, json_name=camel(field))
            if inner in MESSAGES:
                f.type, f.type_name = types.TYPE_MESSAGE, f".{PACKAGE}.{inner}"
            else:
                f.type = kinds[inner]
            if mark == "|":
                f.oneof_index = 0
        for field, (_, kind) in fields.items():  # absent or not: a choice of its own
            if kind[0] == "?":
                f = next(x for x in m.field if x.name == field)
                f.proto3_optional, f.oneof_index = True, len(m.oneof_decl)
                m.oneof_decl.add(name=f"_{field}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return {n: message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PACKAGE}.{n}")) for n in MESSAGES}


def _readers() -> dict:
    """A function from a runtime message to a row for each message, written out field by
    field: what it does per row is attribute access alone."""
    lines, scope = [], {"_json_of": _json_of, "_signed": _signed}
    for name, fields in MESSAGES.items():
        if name in NESTED:
            continue
        if name == "AnyValue":
            lines += ["def AnyValue(m):", "    k = m.WhichOneof('one')", "    d = {}", "    if k is not None:", "        d[k] = _json_of(m) if k in ('array_value', 'kvlist_value') else getattr(m, k)", "    return d"]
            continue
        items = []
        for field, (_, kind) in fields.items():
            many, mark, inner = parts(kind)
            x = f"m.{field}"
            if many:
                v = f"[{inner}(x) for x in {x}]" if inner in MESSAGES else f"list({x})" if inner not in ("fixed64", "uint64") else f"[x if x < {_TOP} else _signed(x) for x in {x}]"
            elif inner in MESSAGES:
                v = f"{inner}({x}) if m.HasField('{field}') else None"
            elif mark:
                v = f"{x} if m.HasField('{field}') else None"
            elif inner in ("fixed64", "uint64"):
                v = f"{x} if {x} < {_TOP} else _signed({x})"
            else:
                v = x
            items.append(f"'{field}': {v}")
        lines += [f"def {name}(m):", f"    return {{{', '.join(items)}}}"]
    exec("\n".join(lines), scope)
    return scope


def _json_of(m) -> str:
    from google.protobuf import json_format

    doc = json_format.MessageToDict(m)
    return json.dumps(next(iter(doc.values()), {}) or {"values": []}, separators=(",", ":"))


@cache
def readers() -> dict:
    return _readers()


def _unfold(x):
    """The row with nested values as messages' fields instead of JSON text."""
    if isinstance(x, list):
        return [_unfold(v) for v in x]
    if isinstance(x, dict):
        return {k: _unfold(_nested("ArrayValue" if k == "array_value" else "KeyValueList", json.loads(v))) if k in ("array_value", "kvlist_value") and isinstance(v, str) else _unfold(v) for k, v in x.items()}
    return x


def encode(signal: str, resources: list) -> bytes:
    request, field, _, _ = LEVELS[signal]
    made = classes()
    if made is None:
        return encode_message(request, {field: resources})
    try:
        return made[request](**{field: resources}).SerializeToString(deterministic=True)
    except (TypeError, ValueError):  # values inside values, or numbers beyond 2^63 - 1
        return encode_message(request, {field: resources})


def decode(signal: str, data: bytes) -> list:
    request, field, _, _ = LEVELS[signal]
    made = classes()
    if made is None:
        return decode_message(request, data)[field]
    m, name = made[request].FromString(data), MESSAGES[request][field][1][1:]
    read = readers()[name]
    return [read(r) for r in getattr(m, field)]
