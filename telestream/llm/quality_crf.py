"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is labelled good or bad; its observation is its own features and those of the
lines before and after it. Exact forward-backward marginals, weighted by line length,
give the document's score. Which lines of a document are good is not known: line labels
are latent, and what is fitted is one function of all weights, the likelihood of the
documents' labels, a document being good with the probability that is its score. So a
good document may have bad lines and a bad one good lines, and transitions are learnt from
where the marginals change. Weights are fitted on the driver on at most ``sample``
labelled rows (those with the smallest hash of their id); the corpus itself is only mapped
over, with no shuffle.

An empty or null text counts as one empty line. Rows with a null id are scored but never
used for fitting. Labels that repeat an id agree by their maximum. With no usable label
every text scores 0.5. Repeated rows and ties score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..packaging import ship
from .common import SPACE, Ragged, few, int_lists, map_rows, small_batches

UPPER, DIGIT, SYMBOL, STOP = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>{}[]=~^_@\\", b"!?"
RAW = 12


def describe(text: bytes) -> np.ndarray:
    """Raw figures of each line: RAW columns and, first, its length in bytes."""
    lines = [x for x in text.split(b"\n") if x.translate(None, SPACE)] or [b""]
    out = np.zeros((len(lines), RAW + 1), np.float32)
    seen: set[bytes] = set()
    for i, x in enumerate(lines):
        words, n = x.split(), len(x)
        k = len(words)
        pairs = sum(map(bytes.__eq__, words, words[1:])) if k > 1 else 0
        m = max(n, 1)
        out[i] = (
            n, (n - len(x.translate(None, SYMBOL))) / m, (n - len(x.translate(None, UPPER))) / m, (n - len(x.translate(None, STOP))) / m, (n - len(x.translate(None, DIGIT))) / m,
            k, n / max(k, 1), len(set(words)) / max(k, 1), pairs / max(k - 1, 1), x in seen, x.rstrip()[-1:] in (b".", b"!", b"?"), x[:1].isupper() or x[:1] >= b"\x80", x.count(b"|"),
        )
        seen.add(x)
    return out


def features(raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Line features, the two neighbours' and a constant; lines are document after document."""
    sym, up, stop, dig, k, mean, uniq, pair, dup, end, cap, bar = raw[:, 1:].T
    own = np.stack([
        np.minimum(sym * 10, 2), sym > 0.02, sym > 0.08, np.minimum(up * 3, 2), up > 0.3, np.minimum(stop * 20, 2), stop > 0.03, np.minimum(dig * 10, 2), dig > 0.2,
        np.log1p(k) / 4, k <= 2, k >= 40, np.minimum(mean / 6, 3), mean > 12, uniq, (uniq < 0.5) & (k > 5), pair, pair > 0.15, dup, end, cap, np.minimum(bar / 4, 2),
    ], axis=1).astype(np.float32)
    n = len(own)
    begin = np.r_[0, np.cumsum(lengths)][:-1]
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first, last = np.zeros(n, np.float32), np.zeros(n, np.float32)
    first[begin], last[begin + lengths - 1] = 1, 1
    before[begin], after[begin + lengths - 1] = 0, 0
    return np.concatenate([own, before, after, first[:, None], last[:, None], np.ones((n, 1), np.float32)], axis=1)


def marginals(unary: np.ndarray, pair: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of each line, expected transitions and the log partition function.

    ``unary``: log-odds of good for each line; ``pair``: 2 x 2 log potentials."""
    lay = Ragged(lengths)
    e = np.zeros((len(unary), 2))
    e[:, 1] = unary[lay.source]
    top = e.max(axis=1, keepdims=True)
    e, m = np.exp(e - top), np.exp(pair)
    alpha, scale = np.empty_like(e), np.empty(len(e))
    for t in range(lay.steps):
        r = lay.rows(t)
        a = e[r] if t == 0 else (alpha[lay.rows(t - 1)][: lay.active[t]] @ m) * e[r]
        scale[r] = s = a.sum(axis=1)
        alpha[r] = a / s[:, None]
    beta, expected = np.ones_like(e), np.zeros((2, 2))
    for t in range(lay.steps - 2, -1, -1):
        n, r, after = lay.active[t + 1], lay.rows(t), lay.rows(t + 1)
        w = beta[after] * e[after] / scale[after][:, None]
        beta[r][:n] = w @ m.T
        expected += (alpha[r][:n].T @ w) * m
    g = alpha * beta
    out = np.empty(len(unary))
    out[lay.source] = g[:, 1] / g.sum(axis=1)
    return out, expected, float(np.log(scale).sum() + top.sum())


@dataclass
class Crf:
    mean: np.ndarray
    sd: np.ndarray
    weights: np.ndarray
    pair: np.ndarray

    def scores(self, raws: list[np.ndarray]) -> np.ndarray:
        lengths = np.array([len(r) for r in raws], np.int64)
        raw = np.concatenate(raws)
        x = (features(raw, lengths) - self.mean) / self.sd
        good, _, _ = marginals(x.astype(np.float64) @ self.weights, self.pair, lengths)
        return aggregate(good, raw[:, 0].astype(np.float64) + 1, lengths)

    def lines(self, text: str) -> list[float]:
        """P(good) of each line of a text that is not blank."""
        raw = describe(text.encode())
        lengths = np.array([len(raw)], np.int64)
        x = (features(raw, lengths) - self.mean) / self.sd
        return marginals(x.astype(np.float64) @ self.weights, self.pair, lengths)[0].tolist()


def aggregate(good: np.ndarray, weight: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Length-weighted means of the lines of each document."""
    begin = np.r_[0, np.cumsum(lengths)][:-1]
    return np.clip(np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin), 0, 1)


def ascent(unary: np.ndarray, pair: np.ndarray, lengths: np.ndarray, weight: np.ndarray, labels: np.ndarray, step: float = 1e-2) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log likelihood of the labels and its gradients by the unary and pair potentials.

    The derivative of a sum of c * marginal by a potential is a covariance, and so that of
    the potential's own expectation in the direction c: two more passes give all of them."""
    good, _, _ = marginals(unary, pair, lengths)
    p = aggregate(good, weight, lengths).clip(1e-4, 1 - 1e-4)
    gain = np.where(labels == 1, 1 / p, -1 / (1 - p)) / len(p)
    begin = np.r_[0, np.cumsum(lengths)][:-1]
    c = np.repeat(gain / np.add.reduceat(weight, begin), lengths) * weight
    top = np.abs(c).max()
    (up, more, _), (down, less, _) = (marginals(unary + s * c / top, pair, lengths) for s in (step, -step))
    value = float(np.log(np.where(labels == 1, p, 1 - p)).mean())
    return value, (up - down) / (2 * step) * top, (more - less) / (2 * step) * top


class Adam:
    def __init__(self, rate: float):
        self.rate, self.i, self.m, self.v = rate, 0, 0.0, 0.0

    def __call__(self, g: np.ndarray) -> np.ndarray:
        self.i += 1
        self.m, self.v = 0.9 * self.m + 0.1 * g, 0.99 * self.v + 0.01 * g * g
        return self.rate * (self.m / (1 - 0.9**self.i)) / (np.sqrt(self.v / (1 - 0.99**self.i)) + 1e-8)


def fit(raws: list[np.ndarray], labels: np.ndarray, first: int = 80, rounds: int = 60, decay: float = 2e-3) -> Crf:
    """Gradient ascent: ``first`` steps of lines that take their document's label, without
    transitions, as the start; then ``rounds`` of the documents' likelihood."""
    width = features(np.zeros((1, RAW + 1), np.float32), np.ones(1, np.int64)).shape[1]
    if not raws:
        return Crf(np.zeros(width), np.ones(width), np.zeros(width), np.zeros((2, 2)))
    lengths = np.array([len(r) for r in raws], np.int64)
    raw = np.concatenate(raws)
    x = features(raw, lengths).astype(np.float64)
    mean, sd = x.mean(axis=0), x.std(axis=0)
    mean[-1], sd[sd < 1e-6] = 0, 1
    x = ((x - mean) / sd).astype(np.float32)
    weight = raw[:, 0].astype(np.float64) + 1
    begin = np.r_[0, np.cumsum(lengths)][:-1]
    share = weight / np.repeat(np.add.reduceat(weight, begin), lengths) / len(lengths)
    y, w, pair = np.repeat(labels.astype(np.float64), lengths), np.zeros(width), np.zeros((2, 2))
    move = Adam(0.1)
    for _ in range(first):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30)))
        w = w + move(x.T @ ((y - p) * share).astype(np.float32) - decay * w)
    move, turn = Adam(0.05), Adam(0.05)
    for _ in range(rounds):
        _, g, h = ascent((x @ w.astype(np.float32)).astype(np.float64), pair, lengths, weight, labels)
        w = w + move(x.T @ g.astype(np.float32) - decay * w)
        pair = pair + turn(h - 0.02 * pair)
    return Crf(mean, sd, w, pair)


def sample_fold(id_col: str = "doc_id") -> Column:
    """The remainder that sets the held-out rows apart: crc32 of the id as text, mod 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, held_out: int | None = 2) -> Crf:
    """Fits on at most ``sample`` labelled rows outside the held-out fold."""
    known = labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    if held_out is not None:
        known = known.filter(sample_fold() != held_out)
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = few(known, sample, known.count(), "doc_id")
    # at most `sample` rows of two numbers: broadcast whatever the size of the corpus
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("quality", "text")

    def raw(b: pa.RecordBatch) -> dict:
        found = [describe((t or "").encode()) for t in b.column("text").to_pylist()]
        return {"quality": b.column("quality"), "raw": int_lists([f.ravel() for f in found], np.float32)}

    got = map_rows(rows, "quality int, raw array<float>", raw, "text").toArrow()
    raws = [np.asarray(r.values, np.float32).reshape(-1, RAW + 1) for r in got.column("raw")]
    return fit(raws, np.asarray(got.column("quality"), np.int64).clip(0, 1))


def _scores(model: Crf, texts: list[bytes]) -> np.ndarray:
    return model.scores([describe(t) for t in texts]) if texts else np.empty(0)


def score(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, score) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    make = lambda b: {"doc_id": b.column("doc_id"), "score": _scores(model, [(t or "").encode() for t in b.column("text").to_pylist()])}
    return map_rows(docs.select("doc_id", "text"), f"doc_id {kind}, score double", make, "text")


def keep(docs: DataFrame, model: Crf, least: float = 0.7) -> DataFrame:
    """The rows that score ``least`` or more, with all their columns."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def good(text: pa.Array) -> pa.Array:
        texts = [(t or "").encode() for t in text.to_pylist()]
        out = [_scores(model, texts[i : i + 512]) for i in range(0, len(texts), 512)]
        return pa.array(np.concatenate(out) >= least if out else np.empty(0, bool))

    return docs.filter(F.arrow_udf(good, "boolean")(F.col("text")))
