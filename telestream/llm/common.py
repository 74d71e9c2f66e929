"""Shared plumbing: folders all executors see, written intermediates, components."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..packaging import shared_dir, ship, small_batches

#: ASCII white space as the contracts use it; bytes.split() splits on exactly these.
SPACE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Tables of fewer than MANY rows are written by FEWEST tasks and one more for each ROWS_A_FILE.
MANY, FEWEST, ROWS_A_FILE = 1_000_000, 4, 20_000


class Workspace:
    """Written intermediates of one call under the shared folder.

    A table that is written and read again has no lineage, so a lost executor costs
    only the tasks it ran. Files are removed when the driver's Python ends, because
    the DataFrames that a call returns read them lazily.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        ship(spark)
        small_batches(spark)
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def table(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """The table, written and read again. Where ``rows``, a bound of its rows, is known to
        be small, it is written by few tasks, as files of some size: a file costs a store some
        calls, and a local one some processes, whatever it holds."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        if rows is not None and rows < MANY:
            df = df.coalesce(FEWEST + rows // ROWS_A_FILE)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        try:
            jvm = self.spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(self.path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may have ended before Python does
            pass


def blobs(column: pa.Array) -> list[bytes]:
    """A string column's UTF-8 bytes, null as empty, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each holds about ``most`` bytes of text (one row at least)."""
    for b in batches:
        lens = np.asarray(pc.fill_null(pc.binary_length(b.column(text)), 0), dtype=np.int64)
        at = 0
        while at < len(lens):
            ends = np.cumsum(lens[at:])
            n = max(1, int(np.searchsorted(ends, most, side="right")))
            yield b.slice(at, n)
            at += n


def map_rows(df: DataFrame, schema: str, make: Callable, text: str | None = None) -> DataFrame:
    """mapInArrow with ``make(batch) -> dict of columns``, batches cut by text size."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    small_batches(df.sparkSession)
    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text) if text else batches:
            if b.num_rows:
                cols = make(b)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == f.type else c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, cols[f.name]) for f in out)], schema=out
                )

    return df.mapInArrow(run, schema)


def int_lists(parts: list[np.ndarray], kind=np.int64) -> pa.Array:
    """A list column from arrays of numbers."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts).astype(kind, copy=False) if parts else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def components(ws: Workspace, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); nodes of one component share a root.

    Random-priority contraction: each node moves to the neighbour (or itself) with the
    smallest keyed hash, edges are relabelled and loops dropped, until none is left. A
    round removes a constant share of the nodes whatever the shape of the graph. Every
    step is a partial aggregate or an equi-join of written tables, so that adaptive
    execution can split the partition of a node with very many edges; nothing reaches
    the driver but a row count per round.
    """
    kind = edges.schema["a"].dataType.simpleString()
    inner = Workspace(ws.spark, "components")
    edges = inner.table(edges.select("a", "b").filter("a <> b").distinct(), "edges", edges.count())
    maps: list[DataFrame] = []
    sizes: list[int] = []
    for r in range(most_rounds):
        n = edges.count()
        if not n:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", F.lit(r)).alias("h"), F.col("b").alias("n"))).alias("m"))
        own = F.struct(F.xxhash64("a", F.lit(r)).alias("h"), F.col("a").alias("n"))
        step = inner.table(near.select(F.col("a").alias("node"), F.least("m", own)["n"].alias("to")), "step", 2 * n)
        maps.append(step)
        left, right = step.select(F.col("node").alias("a"), F.col("to").alias("x")), step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = edges.join(left, "a").join(right, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = inner.table(moved, "edges", n)
        sizes.append(2 * n)
    else:
        raise RuntimeError("components did not settle")
    if not maps:
        return ws.spark.createDataFrame([], f"node {kind}, root {kind}")
    found = maps[-1].select("node", F.col("to").alias("root"))
    for step, n in zip(reversed(maps[:-1]), reversed(sizes[:-1])):
        up = found.select(F.col("node").alias("to"), "root")
        found = inner.table(step.join(up, "to", "left").select("node", F.coalesce("root", "to").alias("root")), "roots", n)
    found = ws.table(found, "roots", sizes[0])
    inner.drop()
    return found


class Ragged:
    """Sequences of unequal length laid out position by position, longest first.

    Recursions along the sequences then run over all of them at once: step t touches
    the slice ``rows(t)``, whose first rows are the sequences that reach t + 1 as well.
    """

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        sizes = lengths[self.order]
        self.steps = int(sizes[0]) if len(sizes) else 0
        self.active = np.searchsorted(-sizes, -np.arange(self.steps), side="left")
        self.starts = np.r_[0, np.cumsum(self.active)]
        first = np.r_[0, np.cumsum(lengths)][:-1][self.order]
        # doc-major index of each position-major cell
        self.source = np.empty(int(self.starts[-1]), np.int64)
        for t in range(self.steps):
            k = self.active[t]
            self.source[self.starts[t] : self.starts[t] + k] = first[:k] + t

    def rows(self, t: int) -> slice:
        return slice(self.starts[t], self.starts[t + 1])


def few(df: DataFrame, n: int, total: int, *by: str) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``by``, out of about ``total`` rows.

    Rows whose hash is beyond twice the share that is needed are dropped where they stand,
    so that the final sort sees a bounded number of rows whatever the table's size.
    """
    h = F.xxhash64(*by)
    if total > 2 * n:
        df = df.filter(F.pmod(h, F.lit(1 << 40)) < int(2 * n / total * (1 << 40)))
    return df.orderBy(F.pmod(h, F.lit(1 << 40)), *by).limit(n)
