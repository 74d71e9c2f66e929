"""Quality rules and the line classifier against brute force and by held-out accuracy."""

import itertools
import os
import random

import numpy as np
import pytest

from telestream.llm import quality_crf, quality_rules

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, kept int"


def longest_by_force(words):
    n = len(words)
    out = [0] * n
    for i, j in itertools.permutations(range(n), 2):
        k = 0
        while i + k < n and j + k < n and words[i + k] == words[j + k]:
            k += 1
        out[i] = max(out[i], k)
    return out


def test_longest_repeats_match_brute_force():
    rng = random.Random(1)
    for _ in range(80):
        docs = [[rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randrange(0, 24))] for _ in range(4)]
        ids = np.array(sum(docs, []), np.int64)
        of = np.repeat(np.arange(4, dtype=np.int32), [len(x) for x in docs])
        assert quality_rules.longest_repeats(ids, of).tolist() == sum(map(longest_by_force, docs), [])


def test_covered_words_are_those_of_windows_found_twice():
    rng = random.Random(2)
    for _ in range(60):
        w = [rng.randrange(3) for _ in range(rng.randrange(0, 40))]
        r = quality_rules.longest_repeats(np.array(w, np.int64), np.zeros(len(w), np.int32))
        for m in (1, 3, 5):
            wins = [tuple(w[i : i + m]) for i in range(len(w) - m + 1)]
            want = {i + k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(m)}
            assert set(np.flatnonzero(quality_rules.covered(r, m))) == want


def test_maximal_repeats():
    t = "a b c d x a b c d y a b c d"
    assert quality_rules.maximal_repeats(t, 4) == [(0, 4), (5, 4), (10, 4)]
    assert quality_rules.maximal_repeats("", 1) == []


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 5) for i, t in texts], COLUMNS)


def test_rules_on_edge_rows(spark):
    clean = " ".join(f"w{i}" for i in range(50))
    lines = "one two three.\n" * 3 + "\n \n" + clean
    long = " ".join(f"v{i % 5000}" for i in range(20000))
    df = rows(spark, [(1, None), (2, ""), (3, clean), (3, clean), (None, "a " * 100), (4, lines), (5, long), (6, clean + " " + clean), (7, "#é$ x y")])
    got = {(r["doc_id"], r["n_words"]): r for r in quality_rules.score(df).collect()}
    assert got[(1, 0)]["base_failed"] and not got[(2, 0)]["kept"]
    assert got[(3, 50)]["kept"] and quality_rules.score(df).filter("doc_id = 3").count() == 2
    assert got[(None, 100)]["n_repeat_words"] == 100 and not got[(None, 100)]["kept"]
    assert got[(4, 59)]["n_dup_lines"] == 2
    assert got[(5, 20000)]["n_repeat_words"] == 20000 and got[(5, 20000)]["longest_repeat"] == 15000
    assert got[(6, 100)]["base_failed"]
    assert got[(7, 2)]["n_symbols"] == 2 and got[(7, 2)]["word_chars"] == 6  # a no-break space is part of a word
    kept = quality_rules.keep(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 3, 4]
    assert quality_rules.score(df.limit(0)).count() == 0 and quality_rules.keep(df.limit(0)).count() == 0


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    lengths, unary, pair = np.array([3, 1, 4]), rng.normal(size=8), rng.normal(size=(2, 2))
    got, expected, log_z = quality_crf.marginals(unary, pair, lengths)
    at, e_all, z_all = 0, np.zeros((2, 2)), 0.0
    for n in lengths:
        total, m, e = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            s = np.exp(sum(unary[at + i] * y[i] for i in range(n)) + sum(pair[y[i], y[i + 1]] for i in range(n - 1)))
            total, m = total + s, m + s * np.array(y)
            for i in range(n - 1):
                e[y[i], y[i + 1]] += s
        assert np.allclose(m / total, got[at : at + n])
        e_all, z_all, at = e_all + e / total, z_all + np.log(total), at + n
    assert np.allclose(e_all, expected) and np.isclose(z_all, log_z)


def corpus(spark, n=240):
    rng = random.Random(4)
    good = lambda: "\n".join(" ".join(rng.choice("the of and house river stone light winter".split()) for _ in range(9)).capitalize() + "." for _ in range(4))
    bad = lambda: "\n".join(" ".join(w + "###" for w in good().upper().split()) for _ in range(3))
    made = [(i, good() if i % 3 else bad()) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    return rows(spark, made), labels, {i: int(i % 3 > 0) for i in range(n)}


def test_classifier_on_held_out_rows(spark):
    docs, labels, want = corpus(spark)
    model = quality_crf.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality_crf.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    held = [r["doc_id"] for r in docs.filter(quality_crf.sample_fold() == 2).select("doc_id").collect()]
    assert len(held) > 30 and np.mean([(got[i] >= 0.7) == want[i] for i in held]) > 0.95
    kept = quality_crf.keep(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s >= 0.7}


def test_classifier_edges(spark):
    docs, labels, _ = corpus(spark, 40)
    odd = rows(spark, [(None, None), (1, ""), (1, ""), (2, "\n\n"), (3, "x" * 100_000 + "\n" * 2000)])
    model = quality_crf.train(docs, labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1, 0), (5, None, 0)], labels.schema)))
    got = quality_crf.score(odd, model).collect()
    assert len(got) == 5 and len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert quality_crf.score(odd.limit(0), model).count() == 0
    blind = quality_crf.train(docs, labels.limit(0))
    assert {r["score"] for r in quality_crf.score(docs, blind).collect()} == {0.5}


@pytest.mark.parametrize("labels", [[1] * 5, [0] * 5])
def test_one_class_is_enough_to_fit(labels):
    m = quality_crf.fit([quality_crf.describe(b"A line.\nAnother.")] * 5, np.array(labels))
    assert (m.scores([quality_crf.describe(b"A line.")])[0] > 0.5) == bool(labels[0])


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(5)
    lengths, weight, labels = np.array([3, 1, 5, 2]), rng.uniform(1, 9, 11), np.array([1, 0, 0, 1])
    unary, pair = rng.normal(size=11), rng.normal(size=(2, 2))
    value, g, h = quality_crf.ascent(unary, pair, lengths, weight, labels, 1e-3)
    at = lambda u, p: quality_crf.ascent(u, p, lengths, weight, labels)[0]
    for i in range(11):
        d = np.eye(11)[i] * 1e-5
        assert g[i] == pytest.approx((at(unary + d, pair) - at(unary - d, pair)) / 2e-5, abs=1e-6)
    for a, b in itertools.product((0, 1), repeat=2):
        d = np.zeros((2, 2))
        d[a, b] = 1e-5
        assert h[a, b] == pytest.approx((at(unary, pair + d) - at(unary, pair - d)) / 2e-5, abs=1e-6)
    assert value < 0


def test_lines_of_a_document_get_labels_of_their_own():
    """Documents are labelled as a whole; their lines are told apart all the same."""
    rng = random.Random(6)
    fine = lambda: " ".join(rng.choice("the of and house river stone light winter".split()) for _ in range(9)).capitalize() + "."
    junk = lambda: " ".join(w + "###" for w in fine().upper().split())
    texts, labels = [], []
    for i in range(400):
        bad = rng.randrange(0, 3) if i % 2 else rng.randrange(6, 10)
        texts.append("\n".join([junk() if k < bad else fine() for k in range(10)]))
        labels.append(int(i % 2))
    model = quality_crf.fit([quality_crf.describe(t.encode()) for t in texts], np.array(labels))
    p = model.lines("\n".join([fine(), fine(), fine(), junk(), junk(), junk(), fine(), fine()]))
    assert min(p[i] for i in (0, 1, 2, 6, 7)) > max(p[3:6]) + 0.3
    assert model.pair[0, 0] + model.pair[1, 1] > model.pair[0, 1] + model.pair[1, 0]


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/labels.parquet"), reason="needs the supplied tables")
def test_held_out_area_under_the_curve(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_crf.score(docs, quality_crf.train(docs, labels)).filter(quality_crf.sample_fold() == 2)
    got = scored.join(labels, "doc_id").select("score", "quality").collect()
    good, bad = ([r["score"] for r in got if r["quality"] == k] for k in (1, 0))
    auc = np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])
    assert len(bad) >= 5 and auc >= 0.95 and np.mean([a >= 0.7 for a in good]) >= 0.95
