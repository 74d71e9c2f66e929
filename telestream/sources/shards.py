"""A sharded stream as a Spark data source, in batch and as a stream.

A stream is a folder of Parquet files with shard_id, seq, partition_key and data, which grows
by files and whose files never change. Offsets are the last sequence read of each shard;
reading begins after it. Shards that appear later begin at their start. A shard whose
parents still have unread records is withheld until they are drained.

The driver keeps an index: shard, first and last sequence and records of each file, from the
file's statistics where it holds one shard, else from its two key columns, read once. With
it a trigger advances each shard to its n-th next record (``maxRecords``), however sparse
sequences are, and reads no data. Each input partition is a stretch of one shard's
sequences, of files that overlap; it reads those files alone.

The engine does not tell a source where a restarted query stands. With the option
``checkpoint`` (the query's checkpointLocation) the source reads it from the engine's offset
log. Without it a restarted query takes all there is in its first batch: the offsets never go
back.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..schema import SHARD_END, TRIM_HORIZON

SCHEMA = "shard_id string, seq long, partition_key string, data binary"
COLUMNS = ["shard_id", "seq", "partition_key", "data"]


@dataclass
class ShardRange(InputPartition):
    shard: str
    after: int
    upto: int
    files: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Stretch:
    """What a file holds of a shard."""

    file: str
    first: int
    last: int
    records: int


def start_after(checkpoint: str | None) -> int:
    """The sequence after which a shard is read: exclusive; -1 for its beginning."""
    if checkpoint in (None, "", TRIM_HORIZON):
        return -1
    if checkpoint == SHARD_END:
        raise ValueError("the shard is already drained")
    return int(checkpoint)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[5:])


class Index:
    """Stretches of each shard, file by file; a file is looked at once."""

    def __init__(self, path: str):
        self.fs, self.root = _open(path)
        self.seen: set[str] = set()
        self.shards: dict[str, list[Stretch]] = {}

    def refresh(self) -> dict[str, list[Stretch]]:
        for info in self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True)):
            name = info.path.rsplit("/", 1)[-1]
            if info.is_file and name.endswith(".parquet") and name[0] not in "._" and info.path not in self.seen:
                for shard, stretch in self._of(info.path):
                    self.shards.setdefault(shard, []).append(stretch)
                self.seen.add(info.path)
        return self.shards

    def _of(self, path: str) -> Iterator[tuple[str, Stretch]]:
        with self.fs.open_input_file(path) as f:
            parquet = pq.ParquetFile(f)
            meta = parquet.metadata
            place = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
            groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
            stats = [(g.column(place["shard_id"]).statistics, g.column(place["seq"]).statistics, g.num_rows) for g in groups if g.num_rows]
            one = {x for s, _, _ in stats if s and s.has_min_max for x in (s.min, s.max)}
            if len(one) == 1 and all(s and s.has_min_max and q and q.has_min_max for s, q, _ in stats):
                yield one.pop(), Stretch(path, min(q.min for _, q, _ in stats), max(q.max for _, q, _ in stats), sum(n for _, _, n in stats))
                return
            for i in range(meta.num_row_groups):
                t = parquet.read_row_group(i, columns=["shard_id", "seq"]).group_by("shard_id").aggregate([("seq", "min"), ("seq", "max"), ("seq", "count")])
                for r in t.to_pylist():
                    yield r["shard_id"], Stretch(path, r["seq_min"], r["seq_max"], r["seq_count"])

    def last(self, shard: str) -> int:
        return max((s.last for s in self.shards.get(shard, [])), default=-1)

    def nth_after(self, shard: str, after: int, n: int) -> int:
        """The sequence of the n-th record after ``after``, or the last one of the shard."""
        return (self.page_ends(shard, after, n) or [self.last(shard)])[-1]

    def page_ends(self, shard: str, after: int, n: int, pages: int = 1) -> list[int]:
        """The last sequence of each of the next pages of ``n`` records after ``after``."""
        ahead = sorted((s for s in self.shards.get(shard, []) if s.last > after), key=lambda s: s.first)
        sure = sum(s.records for s in ahead if s.first > after) + sum(1 for s in ahead if s.first <= after)
        if sure <= n and all(s.first > after for s in ahead):
            return [self.last(shard)] if ahead else []
        found, most = [np.array([], np.int64)], n * pages
        for k, s in enumerate(ahead):
            with self.fs.open_input_file(s.file) as f:
                t = pq.read_table(f, columns=["shard_id", "seq"])
            t = t.filter((pc.field("shard_id") == shard) & (pc.field("seq") > after) & (pc.field("seq") >= s.first) & (pc.field("seq") <= s.last))
            found.append(t.column("seq").to_numpy())
            if sum(map(len, found)) >= most:
                found = [np.unique(np.concatenate(found))]
                if len(found[0]) >= most and (k + 1 == len(ahead) or ahead[k + 1].first > found[0][most - 1]):
                    break
        seqs = np.unique(np.concatenate(found))[:most]
        ends = seqs[n - 1 :: n].tolist()
        return ends if len(seqs) % n == 0 else [*ends, int(seqs[-1])]

    def ranges(self, shard: str, after: int, upto: int) -> list[ShardRange]:
        """Stretches of (after, upto] whose files overlap, one after the other."""
        out: list[ShardRange] = []
        for s in sorted((s for s in self.shards.get(shard, []) if s.last > after and s.first <= upto), key=lambda s: s.first):
            if out and s.first <= out[-1].upto:
                out[-1].upto = max(out[-1].upto, min(s.last, upto))
                if s.file not in out[-1].files:
                    out[-1].files.append(s.file)
            else:
                out.append(ShardRange(shard, max(after, s.first - 1), min(s.last, upto), [s.file]))
        return out


class _Options:
    def __init__(self, options):
        self.path = options["path"]
        self.limit = int(options.get("maxRecords", "10000"))
        if not 0 < self.limit <= 10_000:
            raise ValueError("maxRecords must be in (0, 10000]")
        self.parents: dict[str, list[str]] = json.loads(options.get("parents", "{}"))
        self.start: dict[str, str] = json.loads(options.get("checkpoints", "{}"))
        self.checkpoint = options.get("checkpoint")

    def ended(self, shard: str) -> bool:
        return self.start.get(shard) == SHARD_END

    def rows(self, p: ShardRange) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        data = ds.dataset(p.files, format="parquet", filesystem=fs)
        f = (ds.field("shard_id") == p.shard) & (ds.field("seq") > p.after) & (ds.field("seq") <= p.upto)
        table = data.to_table(columns=COLUMNS, filter=f)
        yield from table.sort_by("seq").to_batches()


class BatchReader(DataSourceReader):
    def __init__(self, options):
        self.options = _Options(options)

    def partitions(self):
        index = Index(self.options.path)
        found = sorted(index.refresh())
        return [r for s in found if not self.options.ended(s) for r in index.ranges(s, start_after(self.options.start.get(s)), index.last(s))]

    def read(self, partition):
        return self.options.rows(partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.options = _Options(options)
        self.index = Index(self.options.path)
        self.at: dict[str, int] | None = None
        self.free = False

    def _begin(self, shard: str) -> int:
        return start_after(self.options.start.get(shard))

    def initialOffset(self) -> dict:
        self.at = {s: self._begin(s) for s in sorted(self.index.refresh()) if not self.options.ended(s)}
        return dict(self.at)

    def _logged(self) -> dict | None:
        """Where the engine's offset log stands: the source's line of its last entry; nothing
        read where the log is empty, None where it is not known."""
        if not self.options.checkpoint:
            return None
        fs, root = _open(self.options.checkpoint)
        log = fs.get_file_info(pafs.FileSelector(f"{root}/offsets", allow_not_found=True))
        entries = sorted((int(i.base_name), i.path) for i in log if i.is_file and i.base_name.isdigit())
        if not entries:
            return {}
        with fs.open_input_stream(entries[-1][1]) as f:
            lines = f.read().decode().splitlines()
        return json.loads(lines[-1]) if lines[-1].startswith("{") else None

    def latestOffset(self) -> dict:
        """Each readable shard advances by ``maxRecords`` records at most."""
        found = self.index.refresh()
        if self.at is None:
            self.at = self._logged()
            # a restarted query whose place is not known: everything, which is never back
            self.free = self.at is None
            self.at = self.at or {}
        out = dict(self.at)
        for s in sorted(found):
            if self.options.ended(s):
                continue
            at = self.at.get(s, self._begin(s))
            open_ = [p for p in self.options.parents.get(s, []) if p in found and not self.options.ended(p)]
            if any(self.at.get(p, -1) < self.index.last(p) for p in open_) and not self.free:
                out.setdefault(s, at)
            else:
                out[s] = self.index.last(s) if self.free else max(at, self.index.nth_after(s, at, self.options.limit))
        self.at, self.free = out, False
        return out

    def partitions(self, start: dict, end: dict):
        self.index.refresh()
        return [r for s, n in sorted(end.items()) for r in self.index.ranges(s, start.get(s, self._begin(s)), n)]

    def read(self, partition):
        return self.options.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the engine's own offset log."""


class ShardSource(DataSource):
    """``spark.read.format("shards")`` and ``readStream``; register with ``register``."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return BatchReader(self.options)

    def streamReader(self, schema):
        return StreamReader(self.options)


def register(spark) -> None:
    """Makes the source known to a session. It travels by value: the processes that plan a
    stream do not look where Python workers find this package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ShardSource)
