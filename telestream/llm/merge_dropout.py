"""SentencePiece encoding and decoding with seeded merge-dropout.

Merge-type (BPE) models start from single characters and merge the adjacent pair whose
piece has the best score, the leftmost of equals. Here each candidate merge is put to a
keyed hash and skipped for good where the hash falls below ``drop``;
the key is the seed, the document, the place of the unit in it and the number of the
decision in the unit's agenda. The same seed
gives the same pieces; another seed gives others; ``drop`` 0 gives the library's own.

Pieces never join a character to a space mark after it, nor to a line end, so a text
falls into units that are encoded alone. Every occurrence of a unit has decisions of its
own. What a unit becomes depends on which of its decisions are skips and on nothing else,
so each distinct (unit, skips) of a batch is encoded once, whatever documents it is from.
A document is keyed by its id, or by its text where the id is null; ``occurrence`` tells
repeated rows of an id apart.

Decoding is lossless for every text: characters without a piece, and the space mark
itself, are written as bytes. Null texts are empty and have no pieces. Rows are treated
one by one, whatever their ids; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import int_lists, map_rows, strings
from .minhash_tensor import mix

MARK = "▁"
#: Stands for a space mark of the text; no unit is empty.
ESCAPE = ""
NONE, PAD, LONG = (1 << 31) - 1, -1, 48
#: A unit of n characters has 3 * (n - 1) decisions at most; those of SHORT fit in 64 bits.
SHORT = 22
MULTIPLIER, MASK, STEP = 0xD6E8FEB86659FD93, (1 << 64) - 1, 0x9E3779B97F4A7C15


def skipped(keys: np.ndarray, decision: np.ndarray | int, bar: int) -> np.ndarray:
    """Whether a decision, by its number in the agenda, is a skip under each key."""
    turn = (np.array(decision, np.uint64, ndmin=1) + np.uint64(1)) * np.uint64(STEP)
    return mix(keys + turn) >> np.uint64(32) < np.uint64(bar)


def skip_masks(keys: np.ndarray, lengths: np.ndarray, bar: int) -> np.ndarray:
    """The decisions that are skips, as bits, of units of at most SHORT characters. Those
    that no agenda reaches are left out: after k skips, the next is below n - 1 + k."""
    masks, live = np.zeros(len(keys), np.uint64), np.arange(len(keys))
    most, bound = 3 * (lengths - 1), lengths - 1
    i = 0
    while len(live := live[i < np.minimum(bound[live], most[live])]):
        skip = live[skipped(keys[live], i, bar)]
        masks[skip] |= np.uint64(1 << i)
        bound[skip] += 1
        i += 1
    return masks


def gather(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    at = np.cumsum(count) - count
    return flat[np.repeat(begin - at, count) + np.arange(int(count.sum()))]


class Pieces:
    """A merge-type model with byte fallback and without normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [-1] * 256
        self.text: list[bytes] = []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(p[3:-1], 16)] = i
                self.text.append(bytes([int(p[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text.append(b"")
            else:
                self.id[p], self.score[p] = i, sp.get_score(i)
                self.text.append(p.replace(MARK, " ").encode())
        if -1 in self.byte:
            raise ValueError("lossless decoding needs a model with byte fallback")
        # marks with what follows them up to the next mark or line end, which no piece joins
        self.units = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        if any(MARK in p.lstrip(MARK) or "\n" in p and len(p) > 1 for p in self.id):
            raise ValueError("the model has pieces that go on past a space or a line end")
        self._tables()

    def _tables(self) -> None:
        """Pairs of symbols and the pieces they make. A symbol is a piece, or a character
        that only stands inside pieces."""
        number = dict(self.id)
        for c in sorted({c for p in self.id for c in p} - set(self.id)):
            number[c] = len(self.text) + ord(c)
        made = [p for p in self.id if len(p) > 1]
        place = {x: r for r, x in enumerate(sorted({-self.score[p] for p in made}))}
        pairs = sorted((number[p[:k]] << 32 | number[p[k:]], place[-self.score[p]], self.id[p]) for p in made for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        keys, ranks, pieces_ = zip(*pairs) if pairs else ([-1], [NONE], [0])
        # an open table of the pairs: a pair stands at its slot or after it, before any free place
        keys, ranks, pieces_ = np.array(keys, np.int64), np.array(ranks, np.int32), np.array(pieces_, np.int32)
        self.shift = np.uint64(64 - max(10, 2 + len(keys).bit_length()))
        size = (1 << (64 - int(self.shift))) + len(keys) + 1
        self.pair_keys, self.pair_ranks, self.pair_pieces = np.full(size, PAD, np.int64), np.full(size, NONE, np.int32), np.zeros(size, np.int32)
        left, slot = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = self.pair_keys[slot[left]] == PAD
            _, first = np.unique(slot[left], return_index=True)
            won = np.zeros(len(left), bool)
            won[first] = True
            won &= free
            w = left[won]
            self.pair_keys[slot[w]], self.pair_ranks[slot[w]], self.pair_pieces[slot[w]] = keys[w], ranks[w], pieces_[w]
            left = left[~won]
            slot[left] += 1
        single = {ord(p): i for p, i in self.id.items() if len(p) == 1}
        self.of_char = np.full(max(single, default=0) + 1, -1, np.int32)
        self.of_char[list(single)] = list(single.values())

    def unit_keys(self, codes: np.ndarray, seed: int, variant: int) -> np.ndarray:
        """A 64-bit key of each row of code points under a seed and a variant."""
        h = np.full(len(codes), (seed * 1_000_003 + variant) & MASK, np.uint64)
        for k in range(codes.shape[1]):
            h = (h ^ codes[:, k].astype(np.uint64)) * np.uint64(MULTIPLIER)
            h ^= h >> np.uint64(29)
        return h

    def encode_units(self, units: list[str], drop: float, seed: int, variant: int) -> list[bytes]:
        """The pieces of units that stand in no document, keyed by their own text."""
        keys = [int(self.unit_keys(np.array([[ord(c) for c in u]], np.uint32), seed, variant)[0]) for u in units]
        flat, begin, count = self.encode_keyed(units, np.arange(len(units)), np.array(keys, np.uint64), int(drop * (1 << 32)))
        return [flat[b : b + c].tobytes() for b, c in zip(begin.tolist(), count.tolist())]

    def encode_keyed(self, units: list[str], which: np.ndarray, keys: np.ndarray, bar: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of ``units[which]`` under keys: ids, and where those of each begin and
        how many there are. Units of a length share arrays. Without ``bar``, keys are masks
        of the decisions that are skips."""
        lengths = np.fromiter(map(len, units), np.int64, count=len(units))[which]
        order = np.argsort(lengths, kind="stable")
        parts, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            for at in range(0, len(same), 1 << 14):
                own = same[at : at + (1 << 14)]
                n = int(lengths[own[0]])
                if 0 < n <= LONG:
                    distinct, back = np.unique(which[own], return_inverse=True)
                    codes = np.frombuffer("".join([units[i] for i in distinct.tolist()]).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n)
                    ids, k = self._together(codes[back], bar, keys[own])
                else:
                    some = [self.as_ids(self.by_heap(list(units[i]), bar or 0, key)) if n else np.array(self._bytes(MARK), np.int32).tobytes() for i, key in zip(which[own].tolist(), keys[own].tolist())]
                    ids, k = np.frombuffer(b"".join(some), np.int32), np.array([len(y) // 4 for y in some], np.int64)
                parts.append(ids)
                counts.append(k)
        begin, count = np.empty(len(which), np.int64), np.empty(len(which), np.int64)
        count[order] = np.concatenate(counts)
        begin[order] = np.cumsum(count[order]) - count[order]
        return np.concatenate(parts), begin, count

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(MULTIPLIER) >> self.shift).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where a pair of symbols stands in the table, or a free place."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = self._slots(key)
        there = self.pair_keys[at]
        todo = np.flatnonzero((there != key) & (there != PAD))
        while len(todo):
            at[todo] += 1
            there = self.pair_keys[at[todo]]
            todo = todo[(there != key[todo]) & (there != PAD)]
        return at

    def _together(self, codes: np.ndarray, bar: int | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The agendas of units of one length, a step of each at a time: the best entry is
        the smallest rank, the leftmost of equals. Each row is a chain of symbols with a
        blank at both ends; a merge leaves a blank where the right symbol was."""
        rows, n = codes.shape
        w = n + 2
        own = np.where(codes < len(self.of_char), self.of_char[np.minimum(codes, len(self.of_char) - 1)], -1).astype(np.int32)
        table = np.full((rows, w), PAD, np.int32)
        table[:, 1:-1] = np.where(own >= 0, own, len(self.text) + codes.astype(np.int32))
        sym = table.reshape(-1)
        after, before = np.arange(1, rows * w + 1), np.arange(-1, rows * w - 1)
        place = np.zeros(rows * w, np.int64)
        ranks = np.full((rows, w), NONE, np.int32)
        rank = ranks.reshape(-1)
        inner = (np.arange(rows)[:, None] * w + np.arange(1, n)[None, :]).reshape(-1)
        place[inner] = self._find(sym[inner], sym[inner + 1])
        rank[inner] = self.pair_ranks[place[inner]]
        ids, decision = np.arange(rows), 0
        while len(ids):
            at = ids * w + ranks[ids].argmin(axis=1)
            live = rank[at] < NONE
            ids, at = ids[live], at[live]
            skip = skipped(keys[ids], decision, bar) if bar is not None else (keys[ids] >> np.uint64(min(decision, 63)) & np.uint64(1)).astype(bool)
            decision += 1
            rank[at[skip]] = NONE
            at = at[~skip]
            gone = after[at]
            then, was = after[gone], before[at]
            new = self.pair_pieces[place[at]]
            sym[at], sym[gone], rank[gone] = new, PAD, NONE
            after[at], before[then] = then, at
            at = np.concatenate([at, was])
            place[at] = found = self._find(sym[at], np.concatenate([sym[then], new]))
            rank[at] = self.pair_ranks[found]
        keep = table != PAD
        flat, counts = table[keep], keep.sum(axis=1)
        odd = flat >= len(self.text)
        if odd.any():  # characters without a piece become bytes
            made = [self._bytes(chr(x - len(self.text))) for x in flat[odd].tolist()]
            times = np.ones(len(flat), np.int64)
            times[odd] = [len(x) for x in made]
            counts = np.bincount(np.repeat(np.arange(rows), counts), times, rows).astype(np.int64)
            flat, odd = np.repeat(flat, times), np.repeat(odd, times)
            flat[odd] = [y for x in made for y in x]
        return flat, counts

    def _bytes(self, text: str) -> list[int]:
        return [self.byte[b] for b in text.encode("utf-8", "surrogatepass")]

    def as_ids(self, parts: list[str]) -> bytes:
        return np.array([i for p in parts for i in ([self.id[p]] if p in self.id else self._bytes(p))], np.int32).tobytes()

    def by_heap(self, parts: list[str | None], bar: int, key: int) -> list[str]:
        """The agenda of one unit of any length, as a heap."""
        n = len(parts)
        after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, int]] = []
        skips = iter(skipped(np.uint64(key), np.arange(3 * n), bar).tolist())

        def offer(i: int, j: int) -> None:
            if (s := self.score.get(parts[i] + parts[j])) is not None:
                heappush(agenda, (-s, i, j, ends[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, end = heappop(agenda)
            if parts[i] is None or after[i] != j or parts[j] is None or ends[j] != end:
                continue
            if next(skips):
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            ends[i] = end
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def decode(self, ids) -> str:
        """The text; the first mark is the model's own."""
        raw = b"".join(map(self.text.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "surrogatepass")


_models: dict[str, Pieces] = {}

def pieces(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


class Encoder:
    """Texts to piece ids (32-bit, as bytes) under one seed."""

    def __init__(self, path: str, drop: float = 0.1, seed: int = 1):
        self.model, self.bar, self.seed = pieces(path), int(drop * (1 << 32)), seed

    def encode(self, text: str, key: int = 0) -> np.ndarray:
        return self.encode_batch([text], [key])[0]

    def encode_batch(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """The texts' pieces; each distinct unit with the same skips is encoded once."""
        split = [self._split(t) for t in texts]
        counts = np.array([len(u) for u in split], np.int64)
        units = list(dict.fromkeys(chain.from_iterable(split)))
        number = dict(zip(units, range(len(units))))
        which = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, count=int(counts.sum()))
        lengths = np.fromiter(map(len, units), np.int64, count=len(units))[which]
        own = mix(np.array([k & MASK for k in keys], np.uint64) + mix(np.array([self.seed + STEP & MASK], np.uint64)))
        begin = np.cumsum(counts) - counts
        places = (np.arange(len(which)) - np.repeat(begin, counts)).astype(np.uint64)
        places = mix(np.repeat(own, counts) + places * np.uint64(MULTIPLIER))
        is_long = lengths > SHORT
        short, long = np.flatnonzero(~is_long), np.flatnonzero(is_long)
        masks = skip_masks(places[short], lengths[short], self.bar)
        order = np.lexsort((masks, which[short]))
        same = np.r_[False, (np.diff(which[short][order]) == 0) & (np.diff(masks[order]) == 0)][: len(order)]
        first = order[~same]
        flat, at, size = self.model.encode_keyed(units, which[short][first], masks[first], None)
        more, at_long, size_long = self.model.encode_keyed(units, which[long], places[long], self.bar)
        starts, sizes = np.empty(len(which), np.int64), np.empty(len(which), np.int64)
        group = np.cumsum(~same) - 1
        starts[short[order]], sizes[short[order]] = at[group], size[group]
        starts[long], sizes[long] = at_long + len(flat), size_long
        ids = gather(np.concatenate([flat, more]), starts, sizes)
        total = np.r_[0, np.cumsum(sizes)]
        return [ids[i:j] for i, j in zip(total[begin].tolist(), total[begin + counts].tolist())]

    def _split(self, text: str) -> list[str]:
        if not text:
            return []
        if MARK not in text:
            return self.model.units.findall(MARK + text.replace(" ", MARK))
        # marks in the text itself are written as bytes, so they cannot be taken for spaces
        units: list[str] = []
        for n, part in enumerate(text.split(MARK)):
            part = part.replace(" ", MARK)
            units += ([ESCAPE] if n else []) + self.model.units.findall(part if n else MARK + part)
        return units


def document_key(doc_id, text: str, occurrence: int | None) -> int:
    """A 64-bit key of a row."""
    name = repr((doc_id is None, str(doc_id), occurrence)).encode()
    if doc_id is None:
        name += text.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little")


def encode(docs: DataFrame, model: str, drop: float = 0.1, seed: int = 1, occurrence: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_pieces, pieces, lossless): ``lossless`` is whether decoding the
    pieces gave the text back. The column ``occurrence`` numbers the rows of a document
    that stands more than once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make(b: pa.RecordBatch) -> dict:
        e = Encoder(model, drop, seed)
        texts = strings(b.column("text"))
        again = b.column("occurrence").to_pylist()
        keys = [document_key(i, t, k) for i, t, k in zip(b.column("doc_id").to_pylist(), texts, again)]
        found = e.encode_batch(texts, keys)
        return {
            "doc_id": b.column("doc_id"),
            "n_bytes": [len(t.encode()) for t in texts],
            "n_pieces": [len(f) for f in found],
            "pieces": int_lists(found, np.int32),
            "lossless": [e.model.decode(f.tolist()) == t for f, t in zip(found, texts)],
        }

    number = F.lit(None).cast("int") if occurrence is None else F.col(occurrence).cast("int")
    return map_rows(docs.select("doc_id", "text", number.alias("occurrence")), f"doc_id {kind}, n_bytes long, n_pieces long, pieces array<int>, lossless boolean", make, "text")


def decoder(model: str) -> Column:
    """A vectorised function from piece ids to text."""

    def run(ids: pa.Array) -> pa.Array:
        m = pieces(model)
        return pa.array([None if v is None else m.decode(v) for v in ids.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")
