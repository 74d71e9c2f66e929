"""Quality rules: suffix-array repetition over whole texts.

Words are encoded as integers, suffixes of each document are ordered by prefix doubling
(only suffixes that still share their prefix are sorted again). Longest common prefixes of
neighbouring suffixes form nested intervals of the order; the deepest one that a suffix is
in gives the longest repeat that starts at its word. Such a repeat is a maximal repeated
substring unless it lies inside that of the word before. The spans of the maximal ones are
united into the repeated part of the document. Memory is 4 bytes * words * log2(longest
repeat) for one slice of documents (about 4 MB of text, or one longer document).

Nulls and empty texts have no words and fail the base rule. Repeated rows are scored
row by row; ids, other columns and their names play no part. Ties cannot occur.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..packaging import ship
from .common import SPACE, blobs, map_rows, small_batches

#: Characters counted as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Base rule: ``min_words`` and ``max_base_percent`` of words in repeated windows of
    ``min_repeat`` words. Method: repeats of ``span`` words or more may cover at most
    ``max_percent`` of the words, and no repeat may be longer than ``max_longest`` words."""

    min_words: int = 20
    min_repeat: int = 8
    max_base_percent: int = 30
    span: int = 5
    max_percent: int = 35
    max_longest: int = 60


def longest_repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position the length of the longest sequence that starts there and also
    starts elsewhere in the same document (copies may overlap).

    ``rank`` holds, for each suffix, the index at which its group of equal h-word
    prefixes begins in suffix order; a round splits each group by the rank h words on.
    """
    n = len(ids)
    longest = np.zeros(n, np.int64)
    if not n:
        return longest
    end = np.searchsorted(doc, doc, side="right")
    key = doc.astype(np.int64) << 32 | ids
    levels: list[np.ndarray] = []
    number = np.int32 if n < 1 << 31 else np.int64
    rank, live, h = np.zeros(n, number), np.arange(n, dtype=number), 1
    while True:
        order = np.argsort(key, kind="stable")
        live, key = live[order], key[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.append(starts, len(live)))
        old = rank[live]
        head = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], np.arange(len(live)), 0))
        rank = rank.copy()
        rank[live] = (old + np.repeat(starts, sizes) - head).astype(number)
        levels.append(rank)
        live = live[np.repeat(sizes, sizes) > 1]
        if not len(live):
            break
        after = live + h
        key = rank[live].astype(np.int64) * (n + 1) + np.where(after < end[live], rank[np.minimum(after, n - 1)] + 1, 0)
        h *= 2
    suffixes = np.empty(n, number)
    suffixes[rank] = np.arange(n, dtype=number)
    a, b = suffixes[:-1], suffixes[1:]
    near = levels[0][a] == levels[0][b]
    a, b = a[near], b[near]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < end[a]) & (y < end[b])
        same = levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)]
        lcp += np.where(inside & same, 1 << k, 0)
    np.maximum.at(longest, a, lcp)
    np.maximum.at(longest, b, lcp)
    return longest


def maximal(repeat: np.ndarray, least: int) -> np.ndarray:
    """The words at which a maximal repeat of ``least`` words or more starts: the repeat of
    the word before does not hold it."""
    return np.flatnonzero((repeat >= least) & ~np.r_[False, repeat[:-1] > repeat[1:]]) if len(repeat) else np.empty(0, np.int64)


def covered(repeat: np.ndarray, least: int) -> np.ndarray:
    """Marks the words of the union of maximal repeats [p, p + repeat[p])."""
    p = maximal(repeat, least)
    edge = np.zeros(len(repeat) + 1, np.int32)
    np.add.at(edge, p, 1)
    np.add.at(edge, p + repeat[p], -1)
    return np.cumsum(edge[:-1]) > 0


def maximal_repeats(text: str, least: int = 8) -> list[tuple[int, int]]:
    """(first word, words) of the maximal repeats of one text: spans that cannot be
    extended to either side and still repeat."""
    words = text.encode().split()
    ids = np.unique(np.array(words, object), return_inverse=True)[1] if words else np.empty(0, np.int64)
    r = longest_repeats(ids, np.zeros(len(ids), np.int32))
    return [(int(p), int(r[p])) for p in maximal(r, least)]


def measure(texts: list[bytes], limits: Limits) -> dict[str, np.ndarray]:
    """The figures and the verdict of each text of a slice."""
    n = len(texts)
    split = [t.split() for t in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    ids = np.fromiter((put(w, len(seen)) for ws in split for w in ws), np.int64, count=int(n_words.sum()))
    doc = np.repeat(np.arange(n, dtype=np.int32), n_words)
    repeat = longest_repeats(ids, doc)
    total = lambda x: np.bincount(doc, weights=x, minlength=n).astype(np.int64)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, doc, repeat)
    strip = bytes.maketrans(b"", b"")
    chars = np.array([len(t.translate(strip, SPACE).decode("utf-8", "replace")) for t in texts], np.int64)
    symbols = np.array([len(t) - len(t.translate(strip, SYMBOLS)) for t in texts], np.int64)
    dup = np.empty(n, np.int64)
    for i, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x.translate(None, SPACE)]
        dup[i] = len(lines) - len(set(lines))
    n_repeat, spanned = total(covered(repeat, limits.min_repeat)), total(covered(repeat, limits.span))
    failed = (n_words < limits.min_words) | (100 * n_repeat > limits.max_base_percent * n_words)
    kept = ~failed & (100 * spanned <= limits.max_percent * n_words) & (longest <= limits.max_longest)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": n_repeat, "base_failed": failed, "covered_words": spanned, "longest_repeat": longest, "kept": kept}


FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, covered_words long, longest_repeat long, kept boolean"


def score(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and figures of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = map_rows(rows, f"id {kind}, {FIELDS}", lambda b: {"id": b.column("id")} | measure(blobs(b.column("text")), limits), "text")
    return out.withColumnRenamed("id", id_col)


def passes(limits: Limits = Limits()) -> "callable":
    """A vectorised predicate over a text column: True where the text is kept."""

    def verdict(text: pa.Array) -> pa.Array:
        texts, out, at = blobs(text), [], 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (to == at or size + len(texts[to]) <= 4 << 20):
                size, to = size + len(texts[to]), to + 1
            out.append(measure(texts[at:to], limits)["kept"])
            at = to
        return pa.array(np.concatenate(out) if out else np.empty(0, bool))

    return F.arrow_udf(verdict, "boolean")


def keep(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with all their columns."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    return docs.filter(passes(limits)(F.col(text_col)))
