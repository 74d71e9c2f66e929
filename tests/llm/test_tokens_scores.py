"""Token counts against the library, segmentations by round trip, scores by enumeration."""

import itertools
import os
import random

import numpy as np
import pytest

from telestream.llm import hmm_scores, merge_dropout, token_counts
from telestream.llm.common import Ragged
from telestream.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer


def strange(n, seed, alphabet):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 18))) for _ in range(n)]


def test_counts_equal_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer(BYTE_BPE))
    texts = strange(5000, 1, [*"ab  \n\t'sé中1. \x1c\x85 　", "<|endoftext|>", "'ll", " the", "\r\n", "ﬁ"])
    count = token_counts.counter(tokenizer(BYTE_BPE))
    assert [count(x) for x in texts] == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", PIECE_BPE])
def test_other_tokenizers_count(name):
    assert token_counts.counter(tokenizer(name))("Hello world, again") > 2


def test_cache_is_used_and_grows(spark, tmp_path):
    rows = [(1, "a b"), (2, "a b"), (None, "zz top"), (3, None), (3, "other <|endoftext|>"), (4, "x " * 2000)]
    df = spark.createDataFrame([(i, t, "d", 9) for i, t in rows], "doc_id long, text string, digest string, n_tokens int")
    cache = f"file://{tmp_path}/cache"
    got = token_counts.count_tokens(df, tokenizer(BYTE_BPE), cache).collect()
    count = token_counts.counter(tokenizer(BYTE_BPE))
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == sorted((i or 0, len(t or ""), count(t or "")) for i, t in rows)
    assert {r["doc_id"]: r["over_limit"] for r in got}[4]
    stored = spark.read.parquet(cache)
    assert stored.count() == 5 and stored.columns == ["digest", "n_tokens", "tokenizer"]
    # what is stored is believed: a changed count comes back, and nothing is encoded again
    stored.withColumn("n_tokens", stored.n_tokens + 1000).write.partitionBy("tokenizer").parquet(f"file://{tmp_path}/other")
    again = token_counts.count_tokens(df, tokenizer(BYTE_BPE), f"file://{tmp_path}/other").collect()
    assert len(again) == len(rows) and all(r["n_tokens"] >= 1000 for r in again) and spark.read.parquet(f"file://{tmp_path}/other").count() == 5
    # another tokenizer has counts of its own in the same cache; only new texts are added
    more = df.unionByName(spark.createDataFrame([(9, "new", "d", 9)], df.schema))
    token_counts.count_tokens(more, tokenizer(PIECE_BPE), cache).collect()
    token_counts.count_tokens(more, tokenizer(BYTE_BPE), cache).collect()
    by = {r["tokenizer"]: r["count"] for r in spark.read.parquet(cache).groupBy("tokenizer").count().collect()}
    assert by == {token_counts.version(tokenizer(BYTE_BPE)): 6, token_counts.version(tokenizer(PIECE_BPE)): 6}
    assert token_counts.count_tokens(df.limit(0), tokenizer(BYTE_BPE)).count() == 0


def test_texts_of_one_normalised_content_share_a_count(spark, tmp_path):
    """A file with a normaliser: what it makes equal is encoded once, special strings aside."""
    name = tokenizer("word_bpe_49k.json")
    texts = ["Hello  World", "hello world", "HELLO\tworld", "e\u0301t\u00e9", "\u00e9te\u0301", "x <|endoftext|>", "X <|endoftext|>", "x  <|endoftext|>", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    count = token_counts.counter(name)
    cache = f"file://{tmp_path}/c"
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, name, cache).collect()}
    assert got == {i: count(t or "") for i, t in enumerate(texts)}
    assert spark.read.parquet(cache).count() < len(texts) - 2
    for t in strange(300, 4, "Aa  \t\u00e9e\u0301Zz"):
        assert count(t) == count(t.lower()) or "\u0301" in t


def test_only_plain_files_are_counted_by_the_faster_coder():
    import copy
    import json

    with open(tokenizer(BYTE_BPE), encoding="utf-8") as f:
        spec = json.load(f)
    assert token_counts.is_plain(spec)
    for where, key, value in (("model", "dropout", 0.1), ("model", "ignore_merges", True), ("model", "end_of_word_suffix", "</w>"), ("pre_tokenizer", "use_regex", False), ("pre_tokenizer", "add_prefix_space", True), ("pre_tokenizer", "type", "Whitespace")):
        other = {**spec, where: {**spec[where], key: value}}
        assert not token_counts.is_plain(other), key
    for key in ("lstrip", "rstrip", "single_word", "normalized"):
        assert not token_counts.is_plain({**spec, "added_tokens": [{**spec["added_tokens"][0], key: True}]})
    assert not token_counts.is_plain({**spec, "normalizer": {"type": "NFC"}})
    turned = copy.copy(spec["model"])
    turned["merges"] = [*spec["model"]["merges"][1:], spec["model"]["merges"][0]]
    assert not token_counts.is_plain({**spec, "model": turned})


def test_segmentations_decode_losslessly():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE_BPE))
    m = merge_dropout.pieces(tokenizer(PIECE_BPE))
    enc = {d: merge_dropout.Encoder(tokenizer(PIECE_BPE), d, seed=3) for d in (0.0, 0.3, 1.0)}
    for t in strange(3000, 2, "ab  \n\ttheé▁中😀 ing\x00.,"):
        for e in enc.values():
            assert m.decode(e.encode(t, 5).tolist()) == t
        if "▁" not in t and "\x00" not in t:
            assert enc[0.0].encode(t).tolist() == sp.encode(t)
    long = "abcdefghij" * 300
    assert enc[0.0].encode(long).tolist() == sp.encode(long) and m.decode(enc[0.3].encode(long).tolist()) == long


def test_seeds_and_drop_rate():
    t = "the quick brown foxes were jumping over lazy neighbours " * 5
    make = lambda d, s: merge_dropout.Encoder(tokenizer(PIECE_BPE), d, s).encode(t).tolist()
    assert make(0.2, 1) == make(0.2, 1) and len({tuple(make(0.2, s)) for s in range(6)}) > 3
    assert len(make(0.0, 1)) < len(make(0.3, 1)) < len(make(1.0, 1)) == len(t) + 1 - t.endswith(" ") * 0


def test_heap_and_arrays_agree():
    m, rng = merge_dropout.pieces(tokenizer(PIECE_BPE)), random.Random(5)
    units = ["".join(rng.choice("▁▁theinga.,é中\x00😀") for _ in range(rng.randrange(1, 48))) for _ in range(2000)]
    for drop in (0, 0.1, 0.5, 1):
        got = m.encode_units(units, drop, 7, 1)
        for u, ids in zip(units, got):
            codes = np.array([[ord(c) for c in u]], np.uint32)
            assert ids == m.as_ids(m.by_heap(list(u), int(drop * 2**32), int(m.unit_keys(codes, 7, 1)[0])))


def test_every_occurrence_has_its_own_segmentation(spark):
    m, word = merge_dropout.pieces(tokenizer(PIECE_BPE)), "internationalization"
    df = spark.createDataFrame([(i, word, 0) for i in range(200)] + [(1000, word, k) for k in range(200)] + [(None, f"{word} {i}", 0) for i in range(200)], "doc_id long, text string, again int")
    rows = merge_dropout.encode(df, tokenizer(PIECE_BPE), 0.3, occurrence="again").collect()
    assert all(r["lossless"] for r in rows)
    distinct = lambda x: len({tuple(r["pieces"]) for r in x})
    assert distinct(r for r in rows if r["doc_id"] is not None and r["doc_id"] < 1000) > 20
    assert distinct(r for r in rows if r["doc_id"] == 1000) > 20
    # within one document as well
    one = merge_dropout.Encoder(tokenizer(PIECE_BPE), 0.3).encode(" ".join([word] * 200), 5).tolist()
    assert len({tuple(x) for x in split_at_marks(m, one)}) > 20
    # two characters are one decision, so nine in ten are merged
    got = merge_dropout.Encoder(tokenizer(PIECE_BPE), 0.1).encode(" ".join(["a"] * 20_000), 5).tolist()
    assert np.mean([len(x) == 1 for x in split_at_marks(m, got)]) == pytest.approx(0.9, abs=0.01)


def split_at_marks(m, ids):
    out = []
    for i in ids:
        if m.text[i][:1] == b" ":
            out.append([])
        out[-1].append(i)
    return out


def test_masks_and_keys_give_the_same_pieces():
    m, rng = merge_dropout.pieces(tokenizer(PIECE_BPE)), random.Random(6)
    units = ["".join(rng.choice("▁theinga.,é中") for _ in range(rng.randrange(1, merge_dropout.SHORT + 1))) for _ in range(2000)]
    keys = np.random.default_rng(1).integers(0, 1 << 64, len(units), dtype=np.uint64)
    for drop in (0, 0.1, 0.5, 1):
        bar = int(drop * 2**32)
        masks = merge_dropout.skip_masks(keys, np.array([len(u) for u in units]), bar)
        for a, b in zip(m.encode_keyed(units, np.arange(2000), masks, None), m.encode_keyed(units, np.arange(2000), keys, bar)):
            assert a.tolist() == b.tolist()


def test_encode_rows(spark):
    df = spark.createDataFrame([(1, "a b", 3), (1, "a b", 3), (None, None, 3), (2, "", 3), (3, "ü▁ " * 30_000, 3)], "doc_id long, text string, pieces int")
    got = merge_dropout.encode(df, tokenizer(PIECE_BPE)).collect()
    assert len(got) == 5 and all(r["lossless"] for r in got)
    back = merge_dropout.encode(df, tokenizer(PIECE_BPE)).select("doc_id", merge_dropout.decoder(tokenizer(PIECE_BPE))("pieces").alias("t")).collect()
    assert {(r["doc_id"], r["t"]) for r in back} == {(1, "a b"), (None, ""), (2, ""), (3, "ü▁ " * 30_000)}
    assert merge_dropout.encode(df.limit(0), tokenizer(PIECE_BPE)).count() == 0


def test_ragged_layout_covers_every_cell():
    lengths = np.array([2, 0, 5, 1])
    lay = Ragged(lengths)
    assert sorted(lay.source.tolist()) == list(range(8)) and lay.active.tolist() == [3, 2, 1, 1, 1]


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    s, c = 3, 4
    start, move, emit = rng.dirichlet(np.ones(s)), rng.dirichlet(np.ones(s), s), rng.dirichlet(np.ones(c), s).T
    seqs = [np.array(x, "<u2") for x in ([0, 1, 3], [2], [3, 3, 0, 1])]
    got, (first, moves, emits) = hmm_scores.forward_backward(seqs, start, move, emit, True)
    plain, _ = hmm_scores.forward_backward(seqs, start, move, emit, False)
    want, f, m, e = [], np.zeros(s), np.zeros((s, s)), np.zeros((c, s))
    for q in seqs:
        total, parts = 0.0, []
        for z in itertools.product(range(s), repeat=len(q)):
            p = start[z[0]] * np.prod([move[a, b] for a, b in zip(z, z[1:])]) * np.prod([emit[x, k] for x, k in zip(q, z)])
            total += p
            parts.append((z, p))
        want.append(np.log10(total))
        for z, p in parts:
            f[z[0]] += p / total
            for a, b in zip(z, z[1:]):
                m[a, b] += p / total
            for x, k in zip(q, z):
                e[x, k] += p / total
    assert np.allclose(got, want) and np.allclose(plain, want)
    assert np.allclose(first, f) and np.allclose(moves, m) and np.allclose(emits, e)


def test_chunks_of_a_long_text_give_the_same_counts():
    rng = np.random.default_rng(3)
    s, c, n = 4, 7, 2999
    start, move, emit = rng.dirichlet(np.ones(s)), rng.dirichlet(np.ones(s), s), rng.dirichlet(np.ones(c), s).T
    seq = rng.integers(0, c, n).astype("<u2")
    want, counts = hmm_scores.forward_backward([seq], start, move, emit, True)
    for width in (7, 64, 1500):
        got, found = hmm_scores.long_recursions(seq, start, move, emit, True, width)
        assert got == pytest.approx(want[0], rel=1e-10)
        assert all(np.allclose(a, b) for a, b in zip(counts, found))
        assert hmm_scores.long_recursions(seq, start, move, emit, False, width)[0] == pytest.approx(want[0], rel=1e-10)


def test_single_precision_counts_are_near():
    rng = np.random.default_rng(4)
    start, move, emit = rng.dirichlet(np.ones(8)), rng.dirichlet(np.ones(8), 8), rng.dirichlet(np.ones(3000), 8).T
    seqs = [rng.integers(0, 3000, k).astype("<u2") for k in (1, 5, 400, 3000)]
    a = hmm_scores.forward_backward(seqs, start, move, emit, True)
    b = hmm_scores.forward_backward(seqs, start, move, emit.astype(np.float32), True)
    assert np.allclose(a[0], b[0], rtol=1e-6) and all(np.allclose(x, y, atol=1e-3) for x, y in zip(a[1], b[1]))


def test_a_long_text_is_scored(spark):
    import time

    df = spark.createDataFrame([(1, "of the house " * 400_000), (2, "of the house"), (3, None)], "doc_id long, text string")
    t = time.time()
    got = {r["doc_id"]: r for r in hmm_scores.score(df, hmm_scores.Plan(states=4, own=10, shapes=8), fold=None).collect()}
    assert got[1]["n_tokens"] == 1_200_001 and got[1]["score"] < 0 and time.time() - t < 120


def test_what_is_broadcast_changes_no_score(spark):
    rng = random.Random(14)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(words[: 10 + 30 * (i % 2)]) for _ in range(20))) for i in range(60)] + [(100 + i, "a b c d e f") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    score = lambda near: {r["doc_id"]: (r["score"], r["base_score"], r["n_known"]) for r in hmm_scores.score(df, hmm_scores.Plan(states=2, own=3, shapes=8, near=near, few_texts=50)).collect()}
    a, b, c = score(0), score(4), score(1000)
    assert all(a[i] == pytest.approx(c[i], rel=1e-9) and b[i] == pytest.approx(c[i], rel=1e-9) for i in c)


def test_scores_are_the_model_s_probabilities(spark):
    """Over all words and the end, what follows a word sums to one: the score of a text is
    exact, held against the recursion by hand over every word of a tiny vocabulary."""
    rows = [(i, " ".join(random.Random(i).choice("aabbbcd") for _ in range(6))) for i in range(50)]
    df = spark.createDataFrame(rows + [(900, "a"), (901, "b"), (902, "c"), (903, "d"), (904, ""), (905, "new")], "doc_id long, text string")
    plan = hmm_scores.Plan(states=2, own=2, shapes=4, few_texts=10, rounds=2)
    train = df.filter("doc_id < 50")
    seen = {}

    def spy(ws, hmm, learn, texts, plan, real=hmm_scores.train):
        real(ws, hmm, learn, texts, plan)
        seen["hmm"] = hmm
        return []

    old, hmm_scores.train = hmm_scores.train, spy
    try:
        got = {r["doc_id"]: r["score"] for r in hmm_scores.score(train.unionByName(df.filter("doc_id >= 900").withColumn("doc_id", df.doc_id)), plan, fold=None).collect()}
    finally:
        hmm_scores.train = old
    h = seen["hmm"]
    assert h.emit.sum(axis=0) == pytest.approx(1) and h.move.sum(axis=1) == pytest.approx(1) and h.start.sum() == pytest.approx(1)
    from collections import Counter

    counts = Counter(w for _, t in [*rows, (0, "a"), (0, "b"), (0, "c"), (0, "d"), (0, "new")] for w in t.split())
    own = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:2]]
    rest = {w: hmm_scores.shape(w.encode(), 4) for w in counts if w not in own}
    size = Counter()
    for w, k in rest.items():
        size[k] += counts[w]
    kinds = Counter(rest.values())

    def force(text):
        p, log = h.start, 0.0
        for w in [*text.split(), None]:
            if w is None:
                k, inside = 4 + len(own), 1.0
            elif w in own:
                k, inside = 4 + own.index(w), 1.0
            else:
                k = hmm_scores.shape(w.encode(), 4)
                inside = (counts[w] + 0.1) / (size[k] + 0.1 * (kinds[k] + 1))
            a = p * h.emit[k]
            log += np.log10(a.sum() * inside)
            p = a / a.sum() @ h.move
        return log

    for i, t in [*rows, (900, "a"), (902, "c"), (904, ""), (905, "new")]:
        assert got[i] == pytest.approx(force(t), rel=1e-9)


def test_training_never_lowers_the_likelihood():
    rng = np.random.default_rng(2)
    seqs = [np.array((rng.integers(0, 3, 30) if i % 2 else rng.integers(3, 6, 30)), "<u2") for i in range(40)]
    h = hmm_scores.Hmm(2, np.ones(6), 1)
    before = h.log10(seqs).sum()
    for _ in range(15):
        h.update(*h.expect(seqs)[1])
    assert h.log10(seqs).sum() > before + 100


def base_by_force(rows, fold=0):
    import zlib
    from collections import Counter

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 10 == fold

    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = lambda t: [*(t or "").translate(lower).encode().split(), None]
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        ws = tokens(t)
        out.append((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)))
    return out


def test_scores_of_a_small_corpus(spark):
    rng = random.Random(6)
    two = ["the of and house river".split(), "der die und haus fluss".split()]
    rows = [(i, " ".join(rng.choice(two[i % 2]) for _ in range(30)) + (f" rare{i}" if i % 4 == 0 else "")) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "the THE Über"), (502, "new " * 40), (502, "new " * 40), (503, "of " * 30_000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, word string")
    plan = hmm_scores.Plan(states=2, own=6, shapes=8, near=20, few_texts=50)
    got = hmm_scores.score(df, plan).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(base_by_force(rows), key=key)):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 0
    fresh = [r for r in got if r["held_out"] and r["n_tokens"] > 20]
    assert sum(r["score"] for r in fresh) > sum(r["base_score"] for r in fresh)
    assert hmm_scores.score(df.limit(0), plan).count() == 0
    none = hmm_scores.score(df.filter("doc_id = 501").withColumn("text", df.text), plan, fold=None).collect()
    assert none[0]["n_tokens"] == 1


def by_force(m, unit, bar, key):
    """The agenda by definition: of all candidates at hand that were not skipped, the best
    score, the leftmost of equals; each is put to the hash once."""
    parts, gone, turn = [(i, c) for i, c in enumerate(unit)], set(), 0
    while True:
        spans = [(a[0], b[0], b[0] + len(b[1])) for a, b in zip(parts, parts[1:])]
        found = [(-m.score[a[1] + b[1]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a[1] + b[1] in m.score and spans[k] not in gone]
        if not found:
            return [p for _, p in parts]
        k = min(found)[1]
        if merge_dropout.skipped(np.uint64(key), turn, bar)[0]:
            gone.add(spans[k])
        else:
            parts[k : k + 2] = [(parts[k][0], parts[k][1] + parts[k + 1][1])]
        turn += 1


def test_dropout_equals_brute_force():
    m, rng = merge_dropout.pieces(tokenizer(PIECE_BPE)), random.Random(16)
    units = ["".join(rng.choice("▁theingatos.,é中") for _ in range(rng.randrange(1, 30))) for _ in range(250)] + ["▁international", "▁" * 7, "a" * 25]
    for drop in (0.1, 0.4, 1):
        bar = int(drop * 2**32)
        for u, ids in zip(units, m.encode_units(units, drop, 3, 1)):
            key = int(m.unit_keys(np.array([[ord(c) for c in u]], np.uint32), 3, 1)[0])
            assert ids == m.as_ids(by_force(m, u, bar, key))


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/documents.parquet"), reason="needs the supplied tables")
def test_counts_of_whole_texts_equal_the_library(spark):
    from tokenizers import Tokenizer

    from telestream.llm import queries

    t = Tokenizer.from_file(tokenizer(BYTE_BPE))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: len(t.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs}
    got = queries.token_totals(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
