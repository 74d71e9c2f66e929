"""Compression of payload columns; Arrow functions, for SQL has none of these."""

from __future__ import annotations

import gzip
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CODECS, ConfigError

STREAM_ID = b"\xff\x06\x00\x00sNaPpY"
_tools: dict[str, object] = {}


def _zstd():
    """One compressor and decompressor per Python worker."""
    if "zstd" not in _tools:
        import zstandard

        _tools["zstd"] = (zstandard.ZstdCompressor(), zstandard.ZstdDecompressor())
    return _tools["zstd"]


def _crc_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """The byte table of CRC-32C, and operators that push a register over 1, 2, 4, ... zero
    bytes, each as four tables by byte of the register."""
    if "crc" not in _tools:
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, table >> 1 ^ np.uint32(0x82F63B78), table >> 1).astype(np.uint32)
        lanes = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
        push = [(lanes >> 8 ^ table[lanes & 0xFF]).astype(np.uint32)]
        for _ in range(40):
            push.append(_over(push[-1], push[-1]))
        _tools["crc"] = (table, push)
    return _tools["crc"]


def _over(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 0xFF] ^ tables[1][crc >> 8 & 0xFF] ^ tables[2][crc >> 16 & 0xFF] ^ tables[3][crc >> 24]


def crc32c(data: bytes) -> int:
    """Registers of equal stretches are run side by side, then joined two by two."""
    table, push = _crc_tables()
    level = max(0, (len(data) // 64).bit_length() - 1)
    width = min(1 << level, 32)
    level = width.bit_length() - 1
    whole = len(data) // width * width
    rows = np.frombuffer(data, np.uint8, whole).reshape(-1, width)
    part = np.zeros(len(rows), np.uint32)
    for k in range(width):
        part = part >> 8 ^ table[(part ^ rows[:, k]) & 0xFF]
    while len(part) > 1:
        if len(part) % 2:  # zeros in front change nothing in a register that starts at 0
            part = np.concatenate([np.zeros(1, np.uint32), part])
        part = _over(push[level], part[0::2]) ^ part[1::2]
        level += 1
    crc, start, n = int(part[0]) if len(part) else 0, np.uint32(0xFFFFFFFF), whole
    for k in range(n.bit_length()):
        if n >> k & 1:
            start = _over(push[k], np.array([start], np.uint32))[0]
    crc ^= int(start)
    for b in data[whole:]:
        crc = crc >> 8 ^ int(table[(crc ^ b) & 0xFF])
    return crc ^ 0xFFFFFFFF


def _masked(data: bytes) -> bytes:
    c = crc32c(data)
    return struct.pack("<I", ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF)


def snappy_size(block: bytes) -> int:
    """The uncompressed length at the head of a block."""
    n = shift = 0
    for b in block:
        n |= (b & 0x7F) << shift
        if b < 0x80:
            return n
        shift += 7
    raise ValueError("a snappy block ends in its length")


def snap(data: bytes) -> bytes:
    return pa.compress(data, "snappy", asbytes=True)


def unsnap(block: bytes) -> bytes:
    return pa.decompress(block, snappy_size(block), "snappy", asbytes=True)


def frame(data: bytes) -> bytes:
    out = [STREAM_ID]
    for at in range(0, len(data), 65536):
        part = data[at : at + 65536]
        packed = snap(part)
        kind, body = (0, packed) if len(packed) < len(part) * 7 // 8 else (1, part)
        out.append(bytes([kind]) + struct.pack("<I", len(body) + 4)[:3] + _masked(part) + body)
    return b"".join(out)


def unframe(data: bytes) -> bytes:
    if not data.startswith(STREAM_ID):
        raise ValueError("not a framed snappy stream")
    at, out = len(STREAM_ID), []
    while at < len(data):
        kind, n = data[at], int.from_bytes(data[at + 1 : at + 4], "little")
        body, at = data[at + 4 : at + 4 + n], at + 4 + n
        if kind in (0, 1):
            part = unsnap(body[4:]) if kind == 0 else body[4:]
            if _masked(part) != body[:4]:
                raise ValueError("a framed snappy chunk has a wrong checksum")
            out.append(part)
        elif kind < 0x80:
            raise ValueError(f"unknown snappy chunk {kind}")
    return b"".join(out)


def _raw(data: bytes) -> bytes:
    c = zlib.compressobj(wbits=-15)
    return c.compress(data) + c.flush()


_PACK: dict[str, Callable[[bytes], bytes]] = {"none": bytes, "gzip": lambda b: gzip.compress(b, mtime=0), "zstd": lambda b: _zstd()[0].compress(b), "snappy": snap, "x-snappy-framed": frame, "zlib": zlib.compress, "deflate": _raw}
_UNPACK: dict[str, Callable[[bytes], bytes]] = {"none": bytes, "gzip": gzip.decompress, "zstd": lambda b: _zstd()[1].decompress(b), "snappy": unsnap, "x-snappy-framed": unframe, "zlib": zlib.decompress, "deflate": lambda b: zlib.decompress(b, wbits=-15)}


def _function(table: dict, codec: str) -> Callable[[bytes], bytes]:
    if codec not in table:
        raise ConfigError(f"unknown codec {codec!r}; known: {', '.join(CODECS)}")
    return table[codec]


def compressor(codec: str) -> Callable[[Column], Column]:
    """The codec as a column function: null for what it cannot compress."""
    _function(_PACK, codec)
    return lambda data: compress(data, codec, strict=False)


def compress(data: Column, codec: str, strict: bool = True) -> Column:
    """The packed payload; without ``strict`` null where it cannot be packed."""
    return _through(data, codec, _function(_PACK, codec), strict)


def decompress(data: Column, codec: str, strict: bool = True) -> Column:
    """The payload; without ``strict`` null where it cannot be unpacked."""
    return _through(data, codec, _function(_UNPACK, codec), strict)


def round_trips(data: Column, names: tuple[str, ...] = CODECS) -> Column:
    """Each payload packed and unpacked by every codec: an array of (codecs, data), one element
    for each different bytes that came back, null for what cannot be unpacked."""
    ways = [(c, _function(_PACK, c), _function(_UNPACK, c)) for c in names]

    def one(b: bytes | None) -> list[dict]:
        found: dict[bytes | None, list[str]] = {}
        for name, pack, unpack in ways:
            packed = None if b is None else pack(b)
            try:
                back = None if packed is None else unpack(packed)
            except Exception:
                back = None
            found.setdefault(back, []).append(name)
        return [{"codecs": c, "data": x} for x, c in found.items()]

    kind = pa.list_(pa.struct([("codecs", pa.list_(pa.string())), ("data", pa.binary())]))

    def run(x: pa.Array) -> pa.Array:
        return pa.array((one(b.as_py()) for b in x), kind, size=len(x))

    return F.arrow_udf(run, "array<struct<codecs: array<string>, data: binary>>")(data.cast("binary"))


def _through(data: Column, codec: str, change: Callable[[bytes], bytes], strict: bool) -> Column:
    if codec == "none":
        return data.cast("binary")

    def one(b: bytes | None) -> bytes | None:
        if b is None:
            return None
        try:
            return change(b)
        except Exception:
            if strict:
                raise
            return None

    def run(x: pa.Array) -> pa.Array:
        return pa.array([one(b) for b in x.to_pylist()], pa.binary())

    return F.arrow_udf(run, "binary")(data.cast("binary"))
