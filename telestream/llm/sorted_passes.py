"""Near-duplicate vectors by sorted projection passes.

A pass sorts the unit vectors by a keyed 62-bit concatenation of random hyperplane signs
and compares each with its next ``window`` neighbours in that order, across partition
edges as well. Pairs whose cosine (in double precision) is high enough are links; links
of all passes are united into components. Links join vectors of one component only, so
each component is then compared block by block, which counts every link of its vectors
however many there are, without writing pairs down.

How many passes. Two vectors at the threshold agree in a bit with probability
p = 1 - acos(least) / pi, and a window reaches as deep as about log2(n / window) equal
bits, so the passes grow with the logarithm of the rows (``passes_for``): a pair is in no
window with probability ``miss`` at most (0.002), at any n, as long as vectors are not
crowded. Where they are, the window's far end still agrees in more bits than that. Such
rows are marked while they are swept, and only they get four times as many further
passes, until none is marked or so few are left that they are compared exhaustively, in
blocks. A row whose window is all links needs no more of them and is not marked.

A pass moves 8-bit forms of the vectors with the exact norm of what rounding took away.
That bounds the error of a product: pairs on the safe side of it are links, pairs inside
it are compared again in double precision from the vectors as they are stored.

Vectors of different lengths never link, each length has passes of its own. Vectors that
are null, empty, zero, or hold null or non-finite components link with nothing, nor do
rows with a null id. Equal vectors are one class, compared once and weighted by their
number; an id that stands on several vectors takes part with each. Repeated rows count as
several vectors. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, components, map_rows

BITS, SLACK = 62, 1e-5
#: A row is crowded if its window ends this many bits deeper than that of evenly spread rows.
DEEPER = 2.0


def units(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors in double precision) of each vector length; rows that
    link with nothing are in none."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lens = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    flat = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), float("nan")))
    begin = np.cumsum(lens) - lens
    for d in np.unique(lens[lens > 0]).tolist():
        at = np.flatnonzero(lens == d)
        x = flat[begin[at][:, None] + np.arange(d)]
        top = np.abs(x).max(axis=1)
        ok = np.isfinite(top) & (top > 0)
        at, x = at[ok], x[ok] / top[ok][:, None]  # no overflow or underflow in the norm
        yield at, x / np.linalg.norm(x, axis=1)[:, None]


def stack(column: pa.Array) -> np.ndarray:
    """Unit vectors of rows that have one length and are all usable."""
    return next((x for _, x in units(column)), np.empty((0, 0)))


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = a = self.up[self.up[a]]
        return int(a)

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b

    def roots(self) -> np.ndarray:
        while not np.array_equal(self.up, up := self.up[self.up]):
            self.up = up
        return self.up

    def join_all(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Joins pairs; those that joined two trees."""
        up = self.roots()
        apart = up[a] != up[b]
        return [(i, j) for i, j in zip(a[apart].tolist(), b[apart].tolist()) if self.join(i, j)]


def depth_of(n: int, window: int) -> float:
    """The bits in which a window's ends agree among n evenly spread rows."""
    return max(0.0, math.log2(max(n, 1) / window) + 1)


def agreement(least: float) -> float:
    """The probability that a pair at the threshold agrees in one bit."""
    return 1 - math.acos(least) / math.pi


def passes_for(n: int, window: int, least: float, miss: float) -> int:
    hit = agreement(least) ** depth_of(n, window)
    return max(1, math.ceil(math.log(miss) / math.log1p(-min(hit, 0.999))))


@functools.lru_cache(512)
def planes(seed: int, number: int, width: int) -> np.ndarray:
    return np.random.default_rng([seed, number, width]).standard_normal((width, BITS))


def keys_of(x: np.ndarray, seed: int, number: int) -> np.ndarray:
    bits = np.zeros((len(x), 64), np.uint8)
    bits[:, 64 - BITS :] = x @ planes(seed, number, x.shape[1]) > 0
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.int64)


def rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit forms of unit vectors, their scales, and the norms of the rest, rounded up."""
    scale = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    q = np.rint(x / scale[:, None].astype(np.float64)).clip(-127, 127).astype(np.int8)
    rest = np.linalg.norm(x - q * scale[:, None].astype(np.float64), axis=1)
    return q, scale, (rest + 1e-6).astype(np.float32)


def in_window(x: np.ndarray, rest: np.ndarray, held: int, window: int, least: float) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(links, pairs to look at again) between rows at most ``window`` apart, the second of
    which is at ``held`` or after; of the links a spanning forest."""
    forest, out, unsure = Forest(len(x)), [], []
    for s in range(1, min(window, len(x) - 1) + 1):
        a = np.arange(max(0, held - s), len(x) - s)
        near = np.einsum("ij,ij->i", x[a], x[a + s])
        bound = rest[a] * (1 + rest[a + s]) + rest[a + s] + SLACK
        sure = near - bound >= least
        out += forest.join_all(a[sure], a[sure] + s)
        unsure.append(a[~sure & (near + bound >= least)] + 1j * s)
    roots, again = forest.roots(), np.concatenate(unsure) if unsure else np.empty(0, complex)
    a = again.real.astype(np.int64)
    b = a + again.imag.astype(np.int64)
    apart = roots[a] != roots[b]
    return out, list(zip(a[apart].tolist(), b[apart].tolist()))


INSIDE, HEAD, TAIL, AGAIN, CROWDED = range(5)
SWEPT = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()), ("lane", pa.int64()), ("place", pa.int64()), ("q", pa.binary()), ("scale", pa.float32()), ("rest", pa.float32())])
SWEPT_DDL = "kind int, a long, b long, part int, lane long, place long, q binary, scale float, rest float"


def _bytes_of(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, width)


def sweep_passes(ws: Workspace, vectors: DataFrame, rows: int, numbers: range, window: int, least: float, seed: int, deep: float) -> DataFrame:
    """What the passes ``numbers`` over (id, v) find: links, the ends of partitions, pairs to
    look at again and crowded rows, as ``SWEPT``."""
    spark = ws.spark

    def keys(b: pa.RecordBatch) -> dict:
        ids = np.asarray(b.column("id"))
        out: dict[str, list] = {k: [] for k in ("lane", "key", "id", "q", "scale", "rest")}
        for at, x in units(b.column("v")):
            q, scale, rest = rounded(x)
            packed = pa.array([r.tobytes() for r in q], pa.binary())
            for p in numbers:
                out["lane"].append(np.full(len(at), x.shape[1] << 20 | p, np.int64))
                out["key"].append(keys_of(x, seed, p))
                for k, v in (("id", ids[at]), ("q", packed), ("scale", scale), ("rest", rest)):
                    out[k].append(v)
        return {k: (pa.concat_arrays(v) if k == "q" else pa.array(np.concatenate(v))) if v else [] for k, v in out.items()}

    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows * len(numbers) // 4096 + 1))
    spread = map_rows(vectors.select("id", "v"), "lane long, key long, id long, q binary, scale float, rest float", keys)
    order = spread.repartitionByRange(n, "lane", "key", "id").sortWithinPartitions("lane", "key", "id")
    order = order.withColumn("part", F.spark_partition_id())

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, seen, held = -1, -1, 0, None

        def rows_of(kind: int, a, b=None, place=None, q=None, scale=None, rest=None) -> pa.RecordBatch:
            k = len(a)
            given = ([kind] * k, a, b, [part] * k, [now] * k, place, q, scale, rest)
            return pa.RecordBatch.from_arrays([pa.nulls(k, f.type) if v is None else pa.array(v, f.type) for v, f in zip(given, SWEPT)], schema=SWEPT)

        def tail() -> pa.RecordBatch:
            ids, _, q, scale, rest = held
            return rows_of(TAIL, ids, place=np.arange(seen - len(ids), seen), q=[r.tobytes() for r in q], scale=scale, rest=rest)

        for b in batches:
            part = b.column("part")[0].as_py()
            lanes = np.asarray(b.column("lane"))
            cuts = np.r_[0, np.flatnonzero(np.diff(lanes)) + 1, len(lanes)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                c, lane = b.slice(lo, hi - lo), int(lanes[lo])
                width = lane >> 20
                new = (np.asarray(c.column("id")), np.asarray(c.column("key")), _bytes_of(c.column("q"), width), np.asarray(c.column("scale")), np.asarray(c.column("rest")))
                if lane != now:
                    if held is not None:
                        yield tail()
                    held, now, seen = tuple(v[:0] for v in new), lane, 0
                if seen < window:  # rows of the first window meet the partition before
                    k = min(window - seen, len(new[0]))
                    yield rows_of(HEAD, new[0][:k], place=np.arange(seen, seen + k), q=[r.tobytes() for r in new[2][:k]], scale=new[3][:k], rest=new[4][:k])
                h = len(held[0])
                ids, key, q, scale, rest = held = tuple(np.concatenate([v, w]) for v, w in zip(held, new))
                seen += len(new[0])
                x = q * scale[:, None]
                links, again = in_window(x, rest, h, window, least)
                for kind, found in ((INSIDE, links), (AGAIN, again)):
                    if found:
                        a, z = np.array(found).T
                        yield rows_of(kind, ids[a], ids[z])
                if len(ids) > window:
                    a = np.arange(max(0, h - window), len(ids) - window)
                    far = np.frexp((key[a] ^ key[a + window]).astype(np.float64))[1]
                    crowded = (BITS - far > deep) & (np.einsum("ij,ij->i", x[a], x[a + window]) < least)
                    if crowded.any():
                        yield rows_of(CROWDED, ids[a[crowded]])
                held = tuple(v[-window:] for v in held)
        if held is not None:
            yield tail()

    return ws.table(order.mapInArrow(sweep, SWEPT_DDL), "passes")


def links_of(ws: Workspace, swept: DataFrame, vectors: DataFrame, window: int, least: float) -> DataFrame:
    """(a, b): the links that passes found, those across partition edges and those that are
    confirmed from the stored vectors among them."""
    # the last rows of a partition meet the first rows of the next one that holds the same pass
    ends = swept.filter(F.col("kind").isin(HEAD, TAIL))
    ends = ends.select("lane", F.when(F.col("kind") == TAIL, F.col("part")).otherwise(F.col("part") - 1).alias("edge"), "kind", "place", F.col("a").alias("id"), "q", "scale", "rest")

    def across(key, table):
        t = table.sort_by([("kind", "descending"), ("place", "ascending")])
        ids, kinds, width = np.asarray(t.column("id")), np.asarray(t.column("kind")), key[0].as_py() >> 20
        h = int((kinds == TAIL).sum())
        links, again = [], []
        if 0 < h < len(ids):
            x = _bytes_of(t.column("q"), width) * np.asarray(t.column("scale"))[:, None]
            links, again = in_window(x, np.asarray(t.column("rest")), h, window, least)
        both = links + again
        return pa.table({"kind": pa.array([INSIDE] * len(links) + [AGAIN] * len(again), pa.int32()), "a": pa.array([int(ids[i]) for i, _ in both], pa.int64()), "b": pa.array([int(ids[j]) for _, j in both], pa.int64())})

    edges = ws.table(ends.groupBy("lane", "edge").applyInArrow(across, "kind int, a long, b long"), "edges")
    both = swept.filter(F.col("kind").isin(INSIDE, AGAIN)).select("kind", "a", "b").unionByName(edges)
    sure = both.filter(F.col("kind") == INSIDE).select("a", "b")
    doubt = both.filter(F.col("kind") == AGAIN).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left, right = vectors.select(F.col("id").alias("a"), F.col("v").alias("x")), vectors.select(F.col("id").alias("b"), F.col("v").alias("y"))

    def confirm(t: pa.RecordBatch) -> dict:
        keep = np.zeros(t.num_rows, bool)
        for (at, x), (_, y) in zip(units(t.column("x")), units(t.column("y"))):
            keep[at] = np.einsum("ij,ij->i", x, y) >= least
        return {k: t.column(k).filter(pa.array(keep)) for k in ("a", "b")}

    again = map_rows(doubt.join(left, "a").join(right, "b"), "a long, b long", confirm)
    return ws.table(sure.unionByName(again), "links")


def every_link(ws: Workspace, vectors: DataFrame, n: int, least: float, block: int = 1024) -> DataFrame:
    """(a, b): a spanning forest of the links among the ``n`` rows of (id, dims, v), found by
    comparing all of them, two blocks at a time."""
    blocks = max(1, math.ceil(n / block))
    own = vectors.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    own = own.select("dims", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "v")

    def compare(key, table):
        mine, ids, x = np.asarray(table.column("own")), np.asarray(table.column("id")), stack(table.column("v"))
        left, right = np.flatnonzero(mine == key[1].as_py()), np.flatnonzero(mine == key[2].as_py())
        forest, out = Forest(len(ids)), []
        for at in range(0, len(left), 256):
            a, b = np.nonzero(x[left[at : at + 256]] @ x[right].T >= least)
            a, b = left[at + a], right[b]
            out += forest.join_all(a[a != b], b[a != b])
        return pa.table({"a": pa.array([int(ids[i]) for i, _ in out], pa.int64()), "b": pa.array([int(ids[j]) for _, j in out], pa.int64())})

    return ws.table(own.groupBy("dims", "i", "j").applyInArrow(compare, "a long, b long"), "every")


def pass_links(ws: Workspace, vectors: DataFrame, n: int, window: int, least: float, miss: float, seed: int) -> DataFrame:
    """(a, b) links of the ``n`` rows of (id, dims, v)."""
    number, more, left = 0, passes_for(n, window, least, miss), n
    found: DataFrame | None = None
    while True:
        if left <= more * window:
            links, crowded = every_link(ws, vectors, left, least), None
        else:
            swept = sweep_passes(ws, vectors, left, range(number, number + more), window, least, seed, depth_of(n, window) + DEEPER)
            links = links_of(ws, swept, vectors, window, least)
            marked = swept.filter(F.col("kind") == CROWDED).groupBy(F.col("a").alias("id")).agg(F.count("*").alias("k"))
            crowded = ws.table(marked.filter(F.col("k") * 4 > more).select("id"), "crowded")
        found = links if found is None else found.unionByName(links)
        left = crowded.count() if crowded is not None else 0
        if not left:
            return found
        vectors = ws.table(vectors.join(crowded, "id"), "again")
        number, more = number + more, more * 4


def near_duplicates(vectors: DataFrame, least: float = 0.95, window: int = 64, miss: float = 0.002, seed: int = 20) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding)."""
    out_ws, ws = Workspace(vectors.sparkSession, "sorted-passes"), Workspace(vectors.sparkSession, "sorted-passes-inner")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    inner = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"

    def clean(b: pa.RecordBatch) -> dict:
        digests: list[bytes | None] = [None] * b.num_rows
        for at, x in units(b.column("v")):
            for i, r in zip(at.tolist(), x + 0.0):
                digests[i] = hashlib.blake2b(r.tobytes(), digest_size=16).digest()
        named = np.asarray(b.column("id").is_valid())
        digest = pa.array([d if ok else None for d, ok in zip(digests, named)], pa.binary())
        return {"row": b.column("row"), "id": b.column("id"), "v": pc.if_else(digest.is_valid(), b.column("v"), None), "digest": digest}

    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").alias("id"), F.col("embedding").cast(inner).alias("v"))
    rows = out_ws.table(map_rows(rows, f"row long, id {kind}, v {inner}, digest binary", clean), "units")
    # a class of equal vectors is named by one of its rows, whose vector stands for it
    classes = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("row"), F.min("id").alias("least_id"), F.count("*").alias("weight"))
    classes = ws.table(classes, "classes")
    chosen = rows.select("row", "v").join(classes.select("row", "weight", "least_id"), "row")
    chosen = ws.table(chosen.select(F.col("row").alias("id"), F.size("v").alias("dims"), "v", "weight", "least_id"), "chosen")
    links = pass_links(ws, chosen.select("id", "dims", "v"), chosen.count(), window, least, miss, seed)
    roots = components(ws, links)
    members = ws.table(chosen.join(roots.withColumnRenamed("node", "id"), "id"), "members")
    # blocks of a component, larger in larger ones: two keys for each pair of blocks that a
    # vector takes part in
    sized = ws.table(members.groupBy("root").agg(F.count("*").alias("k"), F.min("least_id").alias("component_id")), "sized")
    blocks = members.join(sized.select("root", "k"), "root")
    blocks = blocks.withColumn("blocks", F.ceil(F.col("k") / F.greatest(F.lit(64.0), 4 * F.sqrt("k"))).cast("int"))
    blocks = blocks.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "weight", "v")

    def count(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        own, ids, weight = (np.asarray(table.column(c)) for c in ("own", "id", "weight"))
        x = stack(table.column("v"))
        n = np.zeros(len(ids), np.int64)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            near = x[part] @ x[right].T >= least
            if i == j:
                near &= part[:, None] != right[None, :]
            n[part] += near @ weight[right]
            if i != j:
                n[right] += weight[part] @ near
        return pa.table({"id": pa.array(ids), "n": pa.array(n)})

    counted = blocks.groupBy("root", "i", "j").applyInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    named = members.select("id", "root").join(sized.select("root", "component_id"), "root").join(counted, "id").select(F.col("id").alias("row"), "n", "component_id")
    of_class = classes.join(named, "row", "left").select("digest", "weight", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component_id", "least_id").alias("component_id"))
    of_class = out_ws.table(of_class, "of-class")
    ws.drop()
    out = rows.select("id", "digest").join(of_class, "digest", "left")
    n = F.coalesce(F.col("n") + F.col("weight") - 1, F.lit(0)).cast("long")
    out = out.select(F.col("id").alias("vec_id"), n.alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
