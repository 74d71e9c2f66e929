"""Near-duplicate documents: MinHash with tensored banding, confirmed on whole sets.

Two small collections of minhash groups are computed for each document; a table key
combines one group of the first with one of the second, so that GROUPS * GROUPS tables of
2 * ROWS values cost 2 * GROUPS * ROWS hashes. The steps:

1. Documents with equal shingle sets are one node; only one of them is compared.
2. Each table's bucket links its nodes to one of them: candidates, linear in the bucket.
3. Candidates are confirmed on whole shingle sets; confirmed links are united.
4. A bucket whose nodes confirmed links leave in several parts is open. Its nodes are
   compared with a second one of them, another from table to table. In buckets that are
   still open pairs across
   parts are compared, ``BLOCK`` nodes against as many at a time, in the first
   table whose key they share: first by sketches (16 bits of each minhash), which leave
   only nodes that may have a partner; their whole sets are then compared. Nothing is
   capped. A block returns at most one link per node, and pairs whose parts it has already
   joined are not compared.
5. Links are united again; a document's component is named by its smallest doc_id.

With 8 groups of 3 rows, a pair at similarity 0.85 shares a key with probability 0.999, at
0.80 with 0.994; a sketch turns away a pair at the threshold with probability 4e-6. Sets
are compared as 64-bit digests of their shingles, whole sets as 128-bit ones.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased. A text with fewer words than a
shingle has one shingle, the whole sequence; null texts and texts without words have an
empty set and link with nothing. Rows are treated one by one: repeated rows and repeated
ids get a row each; a row with a null id is linked through equal sets only, and its
component is null where no row of it has an id. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, blobs, components, int_lists, map_rows
from .sorted_passes import Forest

GROUPS, ROWS, BLOCK = 8, 3, 128
_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]  # fixed values of a 64-bit finaliser
_rng = np.random.default_rng(6)
_FACTORS = _rng.integers(1, 1 << 63, 2 * GROUPS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_words: dict[bytes, int] = {}


def _word_codes(words: list[bytes]) -> np.ndarray:
    """64-bit digests of words; a worker remembers a bounded number of them."""
    if len(_words) > 150_000:
        _words.clear()
    for w in set(words):
        if w not in _words:
            _words[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    return np.fromiter(map(_words.__getitem__, words), np.uint64, count=len(words))


def shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit digests of each text's ``width``-word shingles."""
    out = []
    for t in texts:
        words = t.lower().split()
        if not words:
            out.append(np.empty(0, np.uint64))
            continue
        c = _word_codes(words)
        n = max(1, len(c) - width + 1)
        h = np.full(n, np.uint64(min(width, len(c))))
        for k in range(min(width, len(c))):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c[k : k + n])
        out.append(np.unique(h))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """2 * GROUPS group values, and the low 16 bits of each minhash, per set (of sets that
    are not empty)."""
    flat = np.concatenate(sets)
    begin = np.r_[0, np.cumsum([len(s) for s in sets])][:-1]
    least = np.stack([np.minimum.reduceat(mix(flat * f), begin) if len(flat) else flat for f in _FACTORS], axis=1)
    groups = least.reshape(len(sets), 2 * GROUPS, ROWS)
    h = np.full(groups.shape[:2], np.uint64(1))
    for k in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + groups[:, :, k])
    return h, least.astype("<u2")


def least_equal(percent: int) -> int:
    """The equal minhashes that a pair at the threshold has, less 4.5 standard deviations."""
    n, p = 2 * GROUPS * ROWS, percent / 100
    return int(n * p - 4.5 * (n * p * (1 - p)) ** 0.5)


def node_of(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sign(b: pa.RecordBatch, width: int) -> dict:
    sets = shingles(blobs(b.column("text")), width)
    full = [s for s in sets if len(s)]
    groups, mins = signatures(full) if full else ((), ())
    sig, low = iter(groups), iter(mins)
    return {
        "id": b.column("id"),
        "n_shingles": [len(s) for s in sets],
        "node": [node_of(s) for s in sets],
        "groups": int_lists([next(sig).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets]),
        "mins": [next(low).tobytes() if len(s) else None for s in sets],
    }


def _sets(b: pa.RecordBatch, width: int) -> dict:
    sets = shingles(blobs(b.column("text")), width)
    return {"node": [node_of(s) for s in sets], "items": int_lists([s.view(np.int64) for s in sets])}


class Block:
    """The nodes of one task: block i of a bucket against block j."""

    def __init__(self, table: pa.Table, i: int, j: int, percent: int):
        own = np.asarray(table.column("own"))
        number: dict = {}
        self.parts = np.array([number.setdefault(p, len(number)) for p in table.column("part").to_pylist()], np.int64)
        self.forest = Forest(len(number))
        self.groups = np.stack([np.asarray(v.values) for v in table.column("groups")])
        self.mins = np.frombuffer(b"".join(table.column("mins").to_pylist()), "<u2").reshape(len(own), -1)
        self.place, self.bar = int(table.column("place")[0].as_py()), least_equal(percent)
        self.left, self.right, self.same = np.flatnonzero(own == i), np.flatnonzero(own == j), i == j

    def partners(self, x: int) -> np.ndarray:
        """Nodes that x is to be compared with here: of another part, with a sketch that is
        near, and no table before this one in which both share a key."""
        y = self.right[self.right > x] if self.same else self.right
        up = self.forest.roots()[self.parts]
        y = y[up[y] != up[x]]
        y = y[(self.mins[y] == self.mins[x]).sum(axis=1) >= self.bar]
        same = self.groups[y] == self.groups[x]
        return y[same[:, :GROUPS].argmax(axis=1) * GROUPS + same[:, GROUPS:].argmax(axis=1) == self.place]


def _hopeful(t: pa.Table, percent: int) -> np.ndarray:
    """Which rows of whole groups (key, i, j), one after the other, may have a partner in
    theirs. All groups are compared at once, each row with the one ``s`` places on."""
    n, bar = t.num_rows, least_equal(percent)
    key, i, j, own, place = (np.asarray(t.column(c)) for c in ("key", "i", "j", "own", "place"))
    group = np.cumsum(np.r_[False, (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)])
    part = np.frombuffer(b"".join(t.column("part").to_pylist()), "<u8").reshape(n, 2)
    mins = np.frombuffer(b"".join(t.column("mins").to_pylist()), "<u2").reshape(n, -1)
    groups = np.asarray(t.column("groups").combine_chunks().flatten()).reshape(n, -1)
    keep = np.zeros(n, bool)
    for s in range(1, n):
        a = np.flatnonzero(group[:-s] == group[s:])
        if not len(a):
            break
        a = a[((i[a] == j[a]) | (own[a] != own[a + s])) & (part[a] != part[a + s]).any(axis=1)]
        a = a[(mins[a] == mins[a + s]).sum(axis=1) >= bar]
        same = groups[a] == groups[a + s]
        a = a[same[:, :GROUPS].argmax(axis=1) * GROUPS + same[:, GROUPS:].argmax(axis=1) == place[a]]
        keep[a] = keep[a + s] = True
    return keep


def hopeful(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of (key, i, j, own, node, part, place, groups, mins) that have a partner in
    their group by sketch."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            ends = np.zeros(t.num_rows, bool)
            for c in ("key", "i", "j"):
                v = np.asarray(t.column(c))
                ends[1:] |= v[1:] != v[:-1]
            last = int(np.flatnonzero(ends)[-1]) if ends.any() else 0
            held = t.slice(last)
            if last:
                whole = t.slice(0, last).combine_chunks()
                yield from whole.filter(pa.array(_hopeful(whole, percent))).cast(schema).to_batches()
        if held is not None and held.num_rows:
            held = held.combine_chunks()
            yield from held.filter(pa.array(_hopeful(held, percent))).cast(schema).to_batches()

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, rows.schema)


def _compare(table: pa.Table, i: int, j: int, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between blocks i and j of a bucket: a spanning forest over their parts."""
    block, node, out = Block(table, i, j, percent), table.column("node").to_pylist(), []
    items = [np.sort(np.asarray(v.values).view(np.uint64)) for v in table.column("items")]
    sizes = np.array([len(v) for v in items], np.int64)
    for x in block.left.tolist():
        y = block.partners(x)
        y = y[100 * np.minimum(sizes[y], sizes[x]) >= percent * np.maximum(sizes[y], sizes[x])]
        if not len(y):
            continue
        at = np.searchsorted(items[x], flat := np.concatenate([items[k] for k in y]))
        hit = items[x][np.minimum(at, sizes[x] - 1)] == flat
        both = np.add.reduceat(hit, np.cumsum(sizes[y]) - sizes[y])
        for k in y[100 * both >= percent * (sizes[x] + sizes[y] - both)].tolist():
            if block.forest.join(int(block.parts[x]), int(block.parts[k])):
                out.append((node[x], node[k]))
    return out


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: documents whose sets satisfy
    100 * intersection >= ``percent`` * union are linked."""
    out_ws, ws = Workspace(docs.sparkSession, "minhash"), Workspace(docs.sparkSession, "minhash-inner")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    signed = out_ws.table(map_rows(rows, f"id {kind}, n_shingles long, node binary, groups array<long>, mins binary", lambda b: _sign(b, width), "text"), "signed")
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.max("n_shingles").alias("n"), F.min("groups").alias("groups"), F.min("mins").alias("mins"))
    n = signed.count()  # bounds of what is written keep small tables in few files
    nodes = ws.table(nodes, "nodes", n)
    pairs = [F.xxhash64(F.lit(i), F.lit(j), F.col("groups")[i], F.col("groups")[GROUPS + j]) for i in range(GROUPS) for j in range(GROUPS)]
    keys = nodes.select("node", F.explode(F.array(*pairs)).alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head <> last").select("key", "head")
    buckets = ws.table(buckets, "buckets")
    held = ws.table(keys.join(buckets, "key"), "held")
    h = held.count()
    candidates = held.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    candidates = ws.table(candidates, "candidates", h)
    wanted = ws.table(candidates.select(F.col("a").alias("node")).unionByName(candidates.select(F.col("b").alias("node"))).distinct(), "wanted", min(2 * h, n))
    w = wanted.count()
    # whole sets of the candidates only, from one row for each
    picked = nodes.join(wanted, "node", "left_semi").select("id", F.col("node").alias("want"))
    named = rows.join(picked, "id").select("text", "want")

    def whole(b: pa.RecordBatch) -> dict:
        made = _sets(b, width)
        ok = [w == n for w, n in zip(b.column("want").to_pylist(), made["node"])]
        keep = pa.array([k for k, v in enumerate(ok) if v], pa.int64())
        return {"node": pa.array(made["node"], pa.binary()).take(keep), "items": made["items"].take(keep)}

    sets = ws.table(map_rows(named, "node binary, items array<long>", whole, "text").dropDuplicates(["node"]), "sets", w)
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))

    def confirmed(some: DataFrame) -> DataFrame:
        both = some.join(left, "a").join(right, "b").withColumn("n", F.size(F.array_intersect("x", "y")))
        return ws.table(both.filter(100 * F.col("n") >= percent * (F.size("x") + F.size("y") - F.col("n"))).select("a", "b"), "links", h)

    def united(links: DataFrame) -> DataFrame:
        roots = components(ws, links).withColumnRenamed("root", "part")
        return ws.table(wanted.join(roots, "node", "left").select("node", F.coalesce("part", "node").alias("part")), "parts", w)

    links = confirmed(candidates)
    parts = united(links)
    placed = ws.table(held.select("key", "node").join(parts, "node"), "placed", h)
    # open buckets once more against a node that differs from table to table: the least by
    # its bytes from another place on
    at = F.pmod(F.col("key"), F.lit(16)).cast("int")
    turned = lambda c, k: F.concat(F.substring(c, k + 1, F.lit(16)), F.substring(c, F.lit(1), k))
    heads = placed.groupBy("key").agg(F.min(turned(F.col("node"), at)).alias("head"), F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
    heads = heads.select("key", turned(F.col("head"), F.pmod(16 - at, F.lit(16))).alias("head"))
    heads = ws.table(heads.join(parts.select(F.col("node").alias("head"), F.col("part").alias("of_head")), "head"), "heads", h)
    again = placed.join(heads, "key").filter("part <> of_head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    links = links.unionByName(confirmed(again))
    parts = united(links)
    placed = ws.table(placed.join(heads.select("key"), "key").select("key", "node").join(parts, "node"), "placed", h)
    # the largest part of a bucket is only compared with the rest, not within itself
    sizes = placed.groupBy("key", "part").agg(F.count("*").alias("k")).groupBy("key")
    open_ = sizes.agg(F.max(F.struct("k", "part")).alias("top"), F.sum("k").alias("k"), F.count("*").alias("parts")).filter("parts > 1")
    open_ = open_.select("key", F.col("top.part").alias("top"), F.ceil(F.col("top.k") / BLOCK).cast("int").alias("big"), F.ceil((F.col("k") - F.col("top.k")) / BLOCK).cast("int").alias("small"))
    rest = placed.join(ws.table(open_, "open", h), "key").join(nodes.select("node", "groups", "mins"), "node")
    rest = rest.withColumn("place", F.array_position(F.array(*pairs), F.col("key")) - 1)
    in_top, at = F.col("part") == F.col("top"), F.xxhash64("node")
    rest = rest.withColumn("own", F.when(in_top, F.pmod(at, F.col("big"))).otherwise(F.col("big") + F.pmod(at, F.col("small"))).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.when(in_top, F.col("big")).otherwise(0), F.col("big") + F.col("small") - 1)))
    rest = rest.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "part", "place", "groups", "mins")
    some = ws.table(hopeful(rest, percent), "hopeful").join(sets, "node")

    def compare(key, table):
        found = _compare(table, key[1].as_py(), key[2].as_py(), percent)
        return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})

    more = ws.table(some.groupBy("key", "i", "j").applyInArrow(compare, "a binary, b binary"), "more")
    roots = components(ws, links.unionByName(more))
    of_node = nodes.select("node", "id").join(roots, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    of_node = ws.table(of_node, "of-node", n)
    lowest = ws.table(of_node.groupBy("root").agg(F.min("id").alias("component_id")), "lowest", n)
    of_node = out_ws.table(of_node.join(lowest, "root").select("node", "component_id"), "components", n)
    ws.drop()
    out = signed.join(of_node, "node", "left")
    out = out.select(F.col("id").alias("doc_id"), "n_shingles", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, with all its columns: that of the smallest id, a null id after
    all others. Rows are told apart by a key of their own, so that repeated and null ids
    neither take other rows with them nor stay as copies."""
    keyed = Workspace(docs.sparkSession, "minhash-keep").table(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text"), width, percent)
    placed = keyed.select("_row", "doc_id").join(found.select(F.col("doc_id").alias("_row"), "component_id"), "_row")
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first"))
    return keyed.join(first.select("first._row"), "_row", "left_semi").select(*docs.columns)
