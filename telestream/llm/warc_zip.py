"""ZIP-packaged web archives: a writer of WARC records and a range reader.

An archive is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz``
(one gzip member per record) and ``indexes/index.cdxj`` (one line per record with the
offset and length of its gzip member). The reader needs nothing but the archives: one task
per archive finds the members through the end record, its ZIP64 form and the central
directory, reads the index a stretch at a time, and deals neighbouring records out as
ranges of bytes; the tasks that follow fetch each range with one read and cut the records
out of it. Nothing is unpacked to disk. Files are opened with pyarrow's file systems, so
that any store they know will do, and are written under the shared folder.

Payloads count as equal if their SHA-1 is, as it is in web archives. Ids may be numbers or
strings. Null payloads are empty. Rows with a null or empty id get records without one, and
their id comes back as null. Rows that
repeat the largest id of equal payloads are all responses. Repeated rows give repeated
records; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, map_rows

END, END64, LOCATOR64, ENTRY, LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
ARCHIVE_BYTES, MOST_TASKS = 64 << 20, 20_000
#: Bytes of index read at a time, and of records in a range.
STRETCH, RANGE_BYTES = 1 << 20, 8 << 20


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int  # offset of the local header


class ZipRanges:
    """The stored members of a ZIP file, read by range from a seekable binary file."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.members = {m.name: m for m in self._directory()}

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the archive ends early")
        return data

    def _directory(self) -> Iterator[Member]:
        n = min(self.size, 22 + FULL16)
        tail = self._at(self.size - n, n)
        p = n
        while p >= 0:
            # the comment may hold the mark too: a real record ends where the file does
            p = tail.rfind(struct.pack("<I", END), 0, p + 3)
            if p >= 0 and p + 22 <= n and p + 22 + struct.unpack_from("<H", tail, p + 20)[0] == n:
                break
        if p < 0:
            raise ValueError("no end record: not a ZIP file")
        count, length, start = struct.unpack_from("<HII", tail, p + 10)
        end = self.size - n + p
        if (count == FULL16 or FULL32 in (length, start)) and end >= 20:
            mark, _, at64, _ = struct.unpack("<IIQI", self._at(end - 20, 20))
            if mark == LOCATOR64:
                record = self._at(at64, 56)
                if struct.unpack_from("<I", record)[0] != END64:
                    raise ValueError("the ZIP64 end record is missing")
                count, length, start = struct.unpack_from("<QQQ", record, 32)
        data, p = self._at(start, length), 0
        for _ in range(count):
            mark, _, _, _, method, _, _, _, packed, size, n_name, n_extra, n_note, _, _, _, offset = struct.unpack_from("<IHHHHHHIIIHHHHHII", data, p)
            if mark != ENTRY:
                raise ValueError("a central directory entry is damaged")
            name = data[p + 46 : p + 46 + n_name].decode("utf-8")
            extra, q = data[p + 46 + n_name : p + 46 + n_name + n_extra], 0
            while q + 4 <= len(extra):
                kind, m = struct.unpack_from("<HH", extra, q)
                if kind == 1:  # ZIP64: holds only the fields whose 32-bit form is full, in this order
                    r = q + 4
                    if size == FULL32:
                        size, r = struct.unpack_from("<Q", extra, r)[0], r + 8
                    if packed == FULL32:
                        packed, r = struct.unpack_from("<Q", extra, r)[0], r + 8
                    if offset == FULL32:
                        offset = struct.unpack_from("<Q", extra, r)[0]
                q += 4 + m
            yield Member(name, method, packed, offset)
            p += 46 + n_name + n_extra + n_note

    def start(self, name: str) -> int:
        """Where a stored member's data begins."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        head = self._at(m.header, 30)
        if struct.unpack_from("<I", head)[0] != LOCAL:
            raise ValueError("a local header is damaged")
        return m.header + 30 + sum(struct.unpack_from("<HH", head, 26))

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        """A range of a stored member."""
        m, start = self.members[name], self.start(name)
        length = m.size - offset if length is None else length
        if offset < 0 or length < 0 or offset + length > m.size:
            raise ValueError("the range leaves the member")
        return self._at(start + offset, length)

    def lines(self, name: str) -> Iterator[bytes]:
        """The lines of a stored member, read a stretch at a time."""
        start, size, rest = self.start(name), self.members[name].size, b""
        for at in range(0, size, STRETCH):
            *whole, rest = (rest + self._at(start + at, min(STRETCH, size - at))).split(b"\n")
            yield from whole
        if rest:
            yield rest


class ZipWriter:
    """Writes stored members one after another; sizes follow the data, always as ZIP64."""

    def __init__(self, out):
        self.out, self.at, self.entries = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.n = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        # bit 3: sizes come after the data
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 8, 0, 0, 0x21, 0, FULL32, FULL32, len(self.name), len(extra)) + self.name + extra)

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.n += len(data)
        self._put(data)

    def finish(self) -> None:
        self._put(struct.pack("<IIQQ", 0x08074B50, self.crc, self.n, self.n))
        self.entries.append((self.name, self.crc, self.n, self.start))

    def close(self) -> None:
        start = self.at
        for name, crc, n, offset in self.entries:
            extra = struct.pack("<HHQQQ", 1, 24, n, n, offset)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", ENTRY, 45, 45, 8, 0, 0, 0x21, crc, FULL32, FULL32, len(name), len(extra), 0, 0, 0, 0, FULL32) + name + extra)
        length, at64 = self.at - start, self.at
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, len(self.entries), len(self.entries), length, start))
        self._put(struct.pack("<IIQI", LOCATOR64, 0, at64, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str | None) -> str:
    return (value or "").replace("\r", "%0D").replace("\n", "%0A")


def record(kind: str, page_id, url: str | None, digest: str, n: int, payload: bytes, refers_to=None) -> bytes:
    """One WARC record, as a gzip member. A revisit has no block; the length of the payload
    it stands for is an extension field."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else quote(str(page_id), safe='')}>", f"WARC-Target-URI: {_one_line(url)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{quote(str(refers_to), safe='')}>", f"X-Payload-Length: {n}"]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n", 1, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record's gzip member."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def assign(pages: DataFrame, least: int = 0) -> DataFrame:
    """Adds digest, refers_to (the largest id of equal payloads of ``least`` bytes or more,
    null for that row itself) to (page_id, url, html).

    The largest ids are found by a partial aggregate and written, so that the join back
    is between plain scans and adaptive execution can split a payload that very many share.
    """
    ws = Workspace(pages.sparkSession, "warc-groups")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    groups = rows.filter(F.octet_length("html") >= least).groupBy("sha").agg(F.max("page_id").alias("leader"), F.count("*").alias("n")).filter("n > 1 AND leader IS NOT NULL")
    groups = ws.table(groups.select("sha", "leader"), "leaders")
    out = rows.join(groups, "sha", "left")
    return out.withColumn("refers_to", F.expr("CASE WHEN leader IS NOT NULL AND NOT (page_id <=> leader) THEN leader END")).drop("leader", "sha")


def write_archives(rows: DataFrame, folder: str, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes (page_id, url, html, refers_to) and returns (path, records) per archive. Each
    task attempt writes names of its own, and only a finished attempt's names are returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        state: dict = {}

        def close() -> pa.RecordBatch:
            z = state["zip"]
            z.finish()
            z.begin("indexes/index.cdxj")
            z.write("".join(state["index"]).encode())
            z.finish()
            z.close()
            state["file"].close()
            out = pa.RecordBatch.from_pydict({"path": [state["name"]], "records": [len(state["index"])]})
            state.clear()
            return out

        for b in batches:
            for i in range(b.num_rows):
                page_id, url, html, to = (b.column(k)[i].as_py() for k in ("page_id", "url", "html", "refers_to"))
                if not state:
                    name = f"{uuid.uuid4().hex}.wacz"
                    f = fs.open_output_stream(f"{root}/{name}")
                    state.update(name=name, file=f, zip=ZipWriter(f), index=[])
                    state["zip"].begin("archive/data.warc.gz")
                payload = (html or "").encode()
                digest = digest32(payload)
                data = record("response" if to is None else "revisit", page_id, url, digest, len(payload), payload, to)
                line = {"url": url, "digest": f"sha1:{digest}", "offset": state["zip"].n, "length": len(data), "filename": "data.warc.gz"}
                state["zip"].write(data)
                state["index"].append(f"{_one_line(url).replace(' ', '%20')} 19700101000000 {json.dumps(line)}\n")
                if state["zip"].n >= most:
                    yield close()
        if state:
            yield close()

    return rows.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records long")


def ranges_of(archives: DataFrame, folder: str, per_task: int) -> DataFrame:
    """(path, start, offsets, lengths): stretches of records that lie side by side, of
    ``per_task`` records and about RANGE_BYTES at most; offsets count from ``start``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        names = ["path", "start", "offsets", "lengths"]
        for b in batches:
            for path in b.column("path").to_pylist():
                where = f"{root}/{path}"
                with fs.open_input_file(where) as f:
                    z = ZipRanges(f, fs.get_file_info(where).size)
                    starts: dict[str, int] = {}
                    part: list[tuple[int, int]] = []

                    def cut() -> pa.RecordBatch:
                        first = part[0][0]
                        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([first]), pa.array([[o - first for o, _ in part]], pa.list_(pa.int64())), pa.array([[n for _, n in part]], pa.list_(pa.int64()))], names=names)

                    for index in sorted(n for n in z.members if n.startswith("indexes/")):
                        for line in z.lines(index):
                            entry = json.loads(line.split(b" ", 2)[2])
                            member, n = f"archive/{entry['filename']}", int(entry["length"])
                            if member not in starts:
                                starts[member] = z.start(member)
                            if not 0 <= int(entry["offset"]) <= z.members[member].size - n:
                                raise ValueError("the range leaves the member")
                            at = starts[member] + int(entry["offset"])
                            if part and (at != sum(part[-1]) or len(part) >= per_task or at + n - part[0][0] > RANGE_BYTES):
                                yield cut()
                                part.clear()
                            part.append((at, n))
                    if part:
                        yield cut()

    return archives.select("path").mapInArrow(run, "path string, start long, offsets array<long>, lengths array<long>")


def page_of(uri: str | None, number: bool) -> int | str | None:
    name = unquote((uri or "").removeprefix("<urn:page:").removesuffix(">"))
    return None if not name else int(name) if number else name


def read_archives(archives: DataFrame, folder: str, per_task: int = 2000, id_kind: str = "bigint", ws: Workspace | None = None) -> DataFrame:
    """Every record of the archives (path): its fields and full-payload figures.

    One large archive is read by many tasks, and a range by one read."""
    ws = ws or Workspace(archives.sparkSession, "warc-read")
    n = archives.count()
    ranges = ws.table(ranges_of(archives.repartition(max(1, min(n, MOST_TASKS))), folder, per_task), "ranges")
    # a range is a few bytes here and megabytes to read, so partitions are set by their number
    ranges = ranges.repartition(max(1, min(ranges.count(), MOST_TASKS)))
    number = id_kind not in ("string", "binary")

    def make(b: pa.RecordBatch) -> dict:
        fs, root = pafs.FileSystem.from_uri(folder)
        out: dict[str, list] = {k: [] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")}
        for path, start, offsets, lengths in zip(*(b.column(c).to_pylist() for c in ("path", "start", "offsets", "lengths"))):
            with fs.open_input_file(f"{root}/{path}") as f:
                f.seek(start)
                data = f.read(offsets[-1] + lengths[-1])
            for offset, n in zip(offsets, lengths):
                fields, block = parse(data[offset : offset + n])
                kind = fields["warc-type"]
                if kind == "response":
                    size, digest = len(block), digest32(block)
                    if f"sha1:{digest}" != fields["warc-payload-digest"]:
                        raise ValueError(f"a payload in {path} does not have its digest")
                else:
                    size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                for k, v in zip(out, (page_of(fields["warc-record-id"], number), fields["warc-target-uri"], size, digest, kind, page_of(fields.get("warc-refers-to"), number))):
                    out[k].append(v)
        return out

    return map_rows(ranges, f"page_id {id_kind}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {id_kind}", make)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes a record per row and reads the archives back."""
    ws = Workspace(pages.sparkSession, "warc")
    folder = f"{ws.path}/archives"
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder[5:]
    manifest = ws.table(write_archives(assign(pages, least), folder), "manifest")
    return read_archives(manifest, folder, id_kind=pages.schema["page_id"].dataType.simpleString(), ws=ws)
