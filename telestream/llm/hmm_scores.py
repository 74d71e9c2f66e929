"""Language-model scores: a hidden Markov model trained by Baum-Welch over the corpus.

A text is its words (A-Z lower-cased) and one end. The model emits word classes from
latent states and words from classes: the ``own`` most frequent words are classes of
their own, other words fall into ``shapes`` classes by a hash of their last three bytes.
Inside a class a word has the probability (c + 0.1) / (C + 0.1 * (V + 1)), with c its
count, C the class's tokens and V its distinct words; the class of a word that was never
seen holds 0.1 / (...) for it. Scaled forward recursion gives the exact likelihood.

* Word counts come from all training texts: counted per slice of text in the workers,
  added up by key. The table of counts is as large as the vocabulary and never moves to
  the driver. The ``own`` words and about ``near`` frequent ones are broadcast, all other
  words meet their counts in a join. Both are chosen through a histogram of counts in
  bins of a 16th of an octave, of which there are a thousand at most; of the last bin
  that fits in part a share by hash is taken. ``near`` changes no result.
* Texts are encoded once as class numbers, two bytes a word, and written. A Baum-Welch
  round runs forward-backward over training texts and adds up expected counts across
  partitions. The first rounds take the share of them that ``shares`` names (by a hash of
  id and text, ``few_texts`` of them at least), so that they grow with the corpus; then rounds
  over all of them follow until the likelihood grows by less than ``settled`` of itself,
  at least two and at most ``rounds``.
* A text of more than ``LONG`` words is cut into chunks of ``CHUNK``. Products of their
  transfer matrices, taken for all chunks side by side, give the exact distribution at
  each cut from both ends; the chunks are then sequences like others, some at a time. So
  memory is two bytes a word and 64 numbers a chunk, and no text takes a step per word.

Null and empty texts are the end alone. Rows with a null id are scored, held out by
none, and learnt from. Repeated rows count and score row by row. With no training text
every count is 0 and classes are equally likely.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Ragged, Workspace, blobs, map_rows, slices

#: Base-score smoothing (fixed by the contract).
ADD = 0.1
COUNTED = 250_000
#: Words of a text that is cut, and of a chunk of it.
LONG, CHUNK = 16_384, 512


@dataclass(frozen=True)
class Plan:
    states: int = 8
    own: int = 2000
    shapes: int = 1024
    near: int = 150_000
    shares: tuple[float, ...] = (1 / 64, 1 / 64, 1 / 64, 1 / 64, 1 / 16, 1 / 16, 1 / 16, 1 / 4, 1 / 4)
    few_texts: int = 1500
    rounds: int = 6
    settled: float = 1e-3
    seed: int = 8


def shape(word: bytes, shapes: int) -> int:
    return zlib.crc32(word[-3:]) % shapes


def count_words(texts: DataFrame, shapes: int) -> DataFrame:
    """(word, shape, n) over a ``text`` column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = list(seen)
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([shape(w, shapes) for w in words], pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["word", "shape", "n"])
            seen.clear()
            return out

        for b in slices(batches, "text"):
            for t in blobs(b.column("text")):
                seen.update(t.lower().split())
            if len(seen) > COUNTED:
                yield flush()
        if seen:
            yield flush()

    got = texts.select("text").mapInArrow(run, "word binary, shape int, n long")
    return got.groupBy("word", "shape").agg(F.sum("n").alias("n"))


def recursions(seqs: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray, learn: bool, last: np.ndarray | None = None):
    """Scaled recursions over sequences side by side: log10 likelihoods, and if ``learn`` the
    expected counts (start of each, move, emit) and the edges (alpha of the last word, beta
    of the first, both rows x states). ``start`` and ``last`` may have a row per sequence:
    the distribution before the first word, and beta of the last one up to a factor.

    Numbers have the precision of ``emit``, scales and sums are in double precision."""
    lay = Ragged(np.array([len(s) for s in seqs], np.int64))
    flat = np.concatenate(seqs).astype(np.int64)[lay.source]
    kind, move = emit.dtype, move.astype(emit.dtype)
    first = (start[lay.order] if start.ndim == 2 else start[None, :]).astype(kind)
    e = emit[flat]
    alpha, scale = (np.empty_like(e) if learn else None), np.empty(len(e))
    back = None
    for t in range(lay.steps):
        r = lay.rows(t)
        a = (first if t == 0 else back[: lay.active[t]] @ move) * e[r]
        s = a.sum(axis=1)
        scale[r] = s
        back = a / s[:, None]
        if learn:
            alpha[r] = back
    doc = np.empty(len(flat), np.int64)
    for t in range(lay.steps):
        doc[lay.rows(t)] = np.arange(lay.active[t])
    log10 = np.empty(len(seqs))
    log10[lay.order] = np.bincount(doc, weights=np.log10(scale), minlength=len(seqs))
    if not learn:
        return log10, None, None
    scale = scale.astype(kind)
    moves, beta = np.zeros(move.shape), np.ones_like(e)
    ends = lay.starts[np.array([len(seqs[i]) for i in lay.order], np.int64) - 1] + np.arange(len(seqs))
    if last is not None:
        b = last[lay.order].astype(kind)
        beta[ends] = b / (alpha[ends] * b).sum(axis=1)[:, None]
    for t in range(lay.steps - 2, -1, -1):
        n, after = lay.active[t + 1], lay.rows(t + 1)
        w = beta[after] * e[after] / scale[after][:, None]
        r = lay.rows(t)
        beta[r][:n] = w @ move.T
        moves += alpha[r][:n].T @ w
    edges = np.empty((len(seqs), len(start.T))), np.empty((len(seqs), len(start.T)))
    edges[0][lay.order], edges[1][lay.order] = alpha[ends], beta[lay.rows(0)]
    alpha *= beta
    alpha /= alpha.sum(axis=1, keepdims=True)
    emits = np.stack([np.bincount(flat, weights=alpha[:, k], minlength=len(emit)) for k in range(len(move))], axis=1)
    begin = np.empty((len(seqs), len(move)))
    begin[lay.order] = alpha[lay.rows(0)]
    return log10, (begin, moves * move, emits), edges


def forward_backward(seqs: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray, learn: bool):
    """log10 likelihoods, and the expected counts (start, move, emit) if ``learn``.

    ``emit``: classes x states."""
    log10, counts, _ = recursions(seqs, start, move, emit, learn)
    return log10, (counts[0].sum(axis=0), *counts[1:]) if learn else None


def transfers(seq: np.ndarray, move: np.ndarray, emit: np.ndarray, width: int) -> np.ndarray:
    """For each chunk of ``width`` words (the last may be shorter) the matrix that takes the
    distribution before its first word to that of its last, up to a factor."""
    n, k = len(seq), len(move)
    out = np.empty((-(-n // width), k, k))
    for lo in range(0, n, width * 256):
        part = seq[lo : lo + width * 256]
        whole = len(part) // width
        for rows, at in ((part[: whole * width].reshape(whole, width), lo // width), (part[whole * width :][None, :], lo // width + whole)):
            if not rows.size:
                continue
            m = np.eye(k)[None, :, :] * emit[rows[:, 0]][:, None, :]
            for t in range(1, rows.shape[1]):
                m = (m @ move) * emit[rows[:, t]][:, None, :]
                m /= m.sum(axis=(1, 2), keepdims=True)
            out[at : at + len(rows)] = m
    return out


def long_recursions(seq: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray, learn: bool, width: int = CHUNK):
    """log10 likelihood and expected counts of one long sequence, by chunks."""
    through = transfers(seq, move, emit.astype(np.float64), width)
    n = len(through)
    before, behind = np.empty((n, len(start))), np.ones((n, len(start)))
    p = start
    for c in range(n):
        before[c] = p = p / p.sum()
        p = p @ through[c] @ move
    for c in range(n - 1, 0, -1):
        b = move @ (through[c] @ behind[c])
        behind[c - 1] = b / b.sum()
    chunks = [seq[i : i + width] for i in range(0, len(seq), width)]
    log10, total, edge = 0.0, None, None
    for at in range(0, n, 256):
        got, counts, edges = recursions(chunks[at : at + 256], before[at : at + 256], move, emit, learn, behind[at : at + 256])
        log10 += float(got.sum())
        if not learn:
            continue
        heads, moves, emits = counts
        # moves from the last word of a chunk to the first of the next one
        tails = edges[0] if edge is None else np.concatenate([edge, edges[0]])
        firsts = (edges[1] * emit[[c[0] for c in chunks[at : at + 256]]])[1 if edge is None else 0 :]
        cross = tails[: len(firsts), :, None] * move[None, :, :] * firsts[:, None, :]
        moves = moves + (cross / cross.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        edge = edges[0][-1:]
        found = (heads[0] if at == 0 else np.zeros(len(start)), moves, emits)
        total = found if total is None else tuple(x + y for x, y in zip(total, found))
    return log10, total


def batches_of(seqs: list[np.ndarray], most: int = 250_000) -> Iterator[list[int]]:
    """Index groups of similar length with a bounded number of tokens; those of more than
    ``LONG`` are left out."""
    out, n = [], 0
    for i in sorted((i for i in range(len(seqs)) if len(seqs[i]) <= LONG), key=lambda i: len(seqs[i])):
        if out and n + len(seqs[i]) > most:
            yield out
            out, n = [], 0
        out.append(i)
        n += len(seqs[i])
    if out:
        yield out


class Hmm:
    def __init__(self, states: int, prior: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.prior = prior / prior.sum()
        self.start = np.full(states, 1 / states)
        self.move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(self.move, 0.9)
        self.move /= self.move.sum(axis=1, keepdims=True)
        e = self.prior[:, None] * rng.gamma(1.0, 1.0, (len(prior), states))
        self.emit = e / e.sum(axis=0)

    def update(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start = (start + 0.1) / (start + 0.1).sum()
        self.move = (move + 0.1) / (move + 0.1).sum(axis=1, keepdims=True)
        e = emit + 20.0 * self.prior[:, None]
        self.emit = e / e.sum(axis=0)

    def _long(self, seqs: list[np.ndarray]) -> list[int]:
        return [i for i, s in enumerate(seqs) if len(s) > LONG]

    def expect(self, seqs: list[np.ndarray]) -> tuple[float, list[np.ndarray]]:
        """The log10 likelihood and the expected counts, in single precision steps."""
        total, log10, emit = [np.zeros_like(self.start), np.zeros_like(self.move), np.zeros_like(self.emit)], 0.0, self.emit.astype(np.float32)
        some = (forward_backward([seqs[i] for i in g], self.start, self.move, emit, True) for g in batches_of(seqs))
        long = (long_recursions(seqs[i], self.start, self.move, emit, True) for i in self._long(seqs))
        for got, found in (*some, *long):
            log10 += float(np.sum(got))
            for t, f in zip(total, found):
                t += f
        return log10, total

    def log10(self, seqs: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(seqs))
        for g in batches_of(seqs):
            out[g], _ = forward_backward([seqs[i] for i in g], self.start, self.move, self.emit, False)
        for i in self._long(seqs):
            out[i], _ = long_recursions(seqs[i], self.start, self.move, self.emit, False)
        return out


def _seqs(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(s, "<u2") for s in column.to_pylist()]


def baum_welch(ws: Workspace, hmm: Hmm, seqs: DataFrame) -> float:
    """One round over all ``seq`` rows: expected counts are added up across partitions and
    the model is updated. Returns the log10 likelihood before the update."""
    shared = ws.spark.sparkContext.broadcast(hmm)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, log10 = None, 0.0
        for b in batches:
            more, found = shared.value.expect(_seqs(b.column("seq")))
            log10 += more
            total = found if total is None else [x + y for x, y in zip(total, found)]
        if total is not None:
            flat = np.concatenate([x.ravel() for x in total] + [[log10]])
            for at in range(0, len(flat), 8192):
                part = flat[at : at + 8192]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(part), dtype=np.int32)), pa.array(part)], names=["i", "v"])

    # a bounded number of parameters, whatever the corpus
    got = seqs.select("seq").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    s, c = len(hmm.start), len(hmm.emit)
    flat = np.zeros(s + s * s + c * s + 1)
    flat[np.asarray(got.column("i"))] = np.asarray(got.column("v"))
    if got.num_rows:
        hmm.update(flat[:s], flat[s : s + s * s].reshape(s, s), flat[s + s * s : -1].reshape(c, s))
    shared.unpersist()
    return float(flat[-1])


def train(ws: Workspace, hmm: Hmm, learn: DataFrame, texts: int, plan: Plan) -> list[tuple[float, float]]:
    """All rounds over (doc_id, seq); (share of the texts, log10 likelihood) of each."""
    place, history = F.pmod(F.xxhash64("doc_id", "seq"), F.lit(1 << 40)), []
    for share in plan.shares if texts else ():
        share = max(share, min(1.0, plan.few_texts / texts))
        some = learn if share >= 1 else learn.filter(place < int(share * (1 << 40)))
        history.append((share, baum_welch(ws, hmm, some)))
    whole: list[float] = []
    while texts and len(whole) < plan.rounds and (len(whole) < 2 or whole[-1] - whole[-2] > plan.settled * abs(whole[-2])):
        whole.append(baum_welch(ws, hmm, learn))
    return history + [(1.0, x) for x in whole]


def octave(n: str = "n"):
    """The bin of a count, a 16th of an octave wide."""
    return F.floor(F.log2(F.col(n).cast("double")) * 16)


def frequent_words(counts: DataFrame, own: int, near: int) -> tuple[pa.Table, pa.Table]:
    """(word, shape, n) of the ``own`` most frequent words, in order, and of about ``near``
    further frequent ones. Both are bounded whatever the counts."""
    bins = sorted(((r["b"], r["k"]) for r in counts.groupBy(octave().alias("b")).agg(F.count("*").alias("k")).collect()), reverse=True)

    def last(n: int) -> tuple[int, int, int]:
        """The bin in which the n-th word is, its size, and the words above it."""
        above = 0
        for b, k in bins:
            if above + k >= n:
                return b, k, above
            above += k
        return (bins[-1][0] - 1 if bins else 0), 0, above

    cut, _, _ = last(own)
    best = counts.filter(octave() >= cut).orderBy(F.desc("n"), "word").limit(own).toArrow()
    cut, size, above = last(near)
    share = 0.95 * (near - above) / size if size else 0.0
    more = counts.filter((octave() > cut) | (octave() == cut) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(min(share, 1) * (1 << 20))))
    return best, more.toArrow()


def score(docs: DataFrame, plan: Plan = Plan(), fold: int | None = 0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows whose crc32(doc_id as text) mod 10 is ``fold`` are held out."""
    spark, ws = docs.sparkSession, Workspace(docs.sparkSession, "hmm")
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == F.lit(-1 if fold is None else fold), F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    counts = ws.table(count_words(rows.filter("NOT held_out"), plan.shapes), "counts")
    ends = rows.filter("NOT held_out").count()
    by_shape = counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    n_all, v_all = sum(r["n"] for r in by_shape) + ends, sum(r["v"] for r in by_shape) + (ends > 0)
    best, more = frequent_words(counts, plan.own, plan.near)
    words = best.column("word").to_pylist()
    fresh = np.flatnonzero(~pc.is_in(more.column("word"), best.column("word")).to_numpy(zero_copy_only=False)) if len(words) else np.arange(len(more))
    more = more.take(fresh)
    top = pa.concat_tables([best, more.select(best.column_names)])
    words = top.column("word").to_pylist()
    count, shapes_of = np.asarray(top.column("n")).astype(np.int64), np.asarray(top.column("shape")).astype(np.int64)
    # class numbers: shapes, then the words of their own, then the end
    c_of, v_of = np.zeros(plan.shapes), np.zeros(plan.shapes)
    for r in by_shape:
        c_of[r["shape"]], v_of[r["shape"]] = r["n"], r["v"]
    own = np.arange(len(best))
    np.subtract.at(c_of, shapes_of[own], count[own])
    np.subtract.at(v_of, shapes_of[own], 1)
    classes = shapes_of.copy()
    classes[own] = plan.shapes + np.arange(len(own))
    end_class = plan.shapes + len(own)
    room = np.log10(c_of + ADD * (v_of + 1))
    inside = np.log10(count + ADD) - room[shapes_of]
    inside[own] = 0.0
    base_room = float(np.log10(n_all + ADD * (v_all + 1)))
    base = np.log10(count + ADD) - base_room
    end_base = float(np.log10(ends + ADD)) - base_room
    table = spark.sparkContext.broadcast((words, classes.astype(np.int32), inside, base, room))
    made: dict = {}

    def encode(b: pa.RecordBatch) -> dict:
        names, cls, within, plain, space = table.value
        if not made:
            made["at"] = {w: i for i, w in enumerate(names)}
        find = made["at"].get
        out: dict[str, list] = {k: [] for k in ("n_tokens", "known", "base", "inside", "seq", "tail")}
        for t in blobs(b.column("text")):
            ws_ = t.lower().split()
            n = len(ws_)
            at = np.fromiter((find(w, -1) for w in ws_), np.int64, count=n)
            far = np.flatnonzero(at < 0)
            seq = np.empty(n + 1, "<u2")
            seq[n] = end_class
            near = at >= 0
            hit = at[near]
            b_sum, i_sum = plain[hit].sum() + end_base, within[hit].sum()
            if len(hit):
                seq[:n][near] = cls[hit]
            tail = [ws_[i] for i in far]
            if tail:
                s = np.array([shape(w, plan.shapes) for w in tail])
                seq[:n][far] = s
                # log10(count + ADD) of these is added by the join
                b_sum -= base_room * len(tail)
                i_sum -= space[s].sum()
            for k, v in zip(out, (n + 1, len(hit) + (ends > 0), b_sum, i_sum, seq.tobytes(), tail)):
                out[k].append(v)
        return {"row": b.column("row"), "doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "tail": pa.array(out.pop("tail"), pa.list_(pa.binary())), **out}

    coded = map_rows(rows.withColumn("row", F.monotonically_increasing_id()), f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, inside double, seq binary, tail array<binary>", encode, "text")
    coded = ws.table(coded, "coded")
    tail = coded.select("row", F.explode("tail").alias("word")).join(counts.select("word", "n"), "word", "left")
    tail = tail.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))).alias("logs"), F.count("n").alias("found"))
    learn = coded.filter("NOT held_out").select("seq", "doc_id")
    prior = np.r_[c_of + ADD * (v_of + 1), count[own], ends + ADD].astype(np.float64)
    hmm = Hmm(plan.states, prior, plan.seed)
    train(ws, hmm, learn, ends, plan)
    model = spark.sparkContext.broadcast(hmm)
    likely = map_rows(coded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "inside", "seq"), f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, score double", lambda b: {c: b.column(c) for c in ("row", "doc_id", "held_out", "n_tokens", "known", "base")} | {"score": model.value.log10(_seqs(b.column("seq"))) + np.asarray(b.column("inside"))})
    out = likely.join(tail, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).cast("long").alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("score") + logs).alias("score"))
