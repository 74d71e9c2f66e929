"""Near-duplicates, mixes and licences against brute force, and the pipeline's stages."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from telestream.llm import license_model, minhash_tensor, quality_rules, source_schedule
from telestream.llm.common import Workspace, components


def components_by_force(sets, percent):
    n = len(sets)
    root = list(range(n))
    for _ in range(n):
        was = list(root)
        for i in range(n):
            for j in range(n):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
        if was == root:
            return root
    return root


def shingle_set(t, width):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(Workspace(spark, "t"), df).collect()}
    assert len({got[i] for i in range(51)}) == 1 and len({got[100 + i] for i in range(30)}) == 1 and len({got[i] for i in (200, 201, 202)}) == 1
    assert len(set(got.values())) == 3 and 300 not in got
    assert components(Workspace(spark, "t"), df.limit(0)).count() == 0


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for g in range(12):
        base = [word() for _ in range(80)]
        for _ in range(rng.choice([1, 2, 6, 30])):
            t = list(base)
            for _ in range(rng.randrange(0, 5)):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    texts += [texts[0].upper(), texts[0], "", None, "a b", "A  b", "a", " \n "]
    df = spark.createDataFrame([(i, t, "n", i) for i, t in enumerate(texts)], "doc_id long, text string, node string, key int")
    for width, percent in ((3, 85), (5, 80)):
        got = {r["doc_id"]: r for r in minhash_tensor.near_duplicates(df, width, percent).collect()}
        sets = [shingle_set(t, width) for t in texts]
        assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
        assert [got[i]["component_id"] for i in range(len(texts))] == components_by_force(sets, percent)
    kept = minhash_tensor.keep(df)
    assert kept.columns == df.columns and kept.count() == len(set(components_by_force([shingle_set(t, 5) for t in texts], 80)))


def test_open_buckets_of_a_template_are_compared_in_blocks(spark, monkeypatch):
    """Texts of one template at a similarity below the threshold share many keys; links
    between them that no bucket's head takes part in are found block by block."""
    monkeypatch.setattr(minhash_tensor, "BLOCK", 4)
    rng = random.Random(12)
    frame = [f"t{i}" for i in range(100)]
    texts = []
    for _ in range(25):
        own = [f"x{rng.randrange(10**9)}" for _ in range(22)]
        texts += [" ".join(frame + own), " ".join(frame + own[:-1] + [f"y{rng.randrange(10**9)}"])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash_tensor.near_duplicates(df, 3, 85).collect()}
    want = components_by_force([shingle_set(t, 3) for t in texts], 85)
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) == 25


def test_sketches_let_pairs_at_the_threshold_pass():
    rng = np.random.default_rng(13)
    for percent in (80, 85):
        low = 100
        for _ in range(200):
            n = 400
            both = int(round(n * 2 * percent / (100 + percent)))
            x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            y = np.concatenate([x[:both], rng.integers(0, 1 << 63, n - both, dtype=np.uint64)])
            _, mins = minhash_tensor.signatures([np.unique(x), np.unique(y)])
            low = min(low, int((mins[0] == mins[1]).sum()))
        assert minhash_tensor.least_equal(percent) <= low


def test_near_duplicate_edges(spark):
    rows = [(None, "x y z"), (3, "x y z"), (3, "x y z"), (None, None), (9, "long " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in minhash_tensor.near_duplicates(df).collect()), key=str)
    assert got == sorted([(-1, 3, False), (3, 3, True), (3, 3, True), (-1, None, True), (9, 9, True)], key=str)
    assert minhash_tensor.near_duplicates(df.limit(0)).count() == 0 and minhash_tensor.keep(df.limit(0)).count() == 0


@pytest.mark.parametrize("sizes, weights", [([100, 10, 1, 50], [5, 2, 1, 5]), ([0, 10, 10], [5, 2, 1]), ([7], [5]), ([], []), ([5, 5, 1000], [5, 5, 1])])
def test_targets_share_everything(sizes, weights):
    got = source_schedule.targets(sizes, weights)
    assert sum(got) == pytest.approx(sum(sizes)) and all(g <= 3 * s + 1e-9 for g, s in zip(got, sizes))
    free = [i for i, (g, s) in enumerate(zip(got, sizes)) if g < 3 * s - 1e-9]
    assert len({round(got[i] / weights[i], 6) for i in free}) <= 1


@pytest.mark.parametrize("sizes", [[100, 10, 1, 50], [0, 10, 10], [7], [], [5, 5, 1000, 3, 9, 0, 2], [1, 1, 10**12]])
def test_targets_of_a_table_of_sources(spark, sizes):
    ws = Workspace(spark, "t")
    names = ["b", "Z", "é", "a", None, "aa", "zz"][: len(sizes)]
    order = sorted(range(len(sizes)), key=lambda i: (names[i] is None, (names[i] or "").encode()))
    per = spark.createDataFrame([(names[i], sizes[i], 5000) for i in range(len(sizes))], "source string, size long, n long")
    plan, n_slots = source_schedule.plan_sources(ws, per, (5, 2, 1), 128, 3.0)
    got = sorted(plan.collect(), key=lambda r: r["source_no"])
    assert [r["source"] for r in got] == [names[i] for i in order]
    want = source_schedule.targets([sizes[i] for i in order], [(5, 2, 1)[k % 3] for k in range(len(order))])
    assert [r["target"] for r in got] == pytest.approx(want) and all(r["parts"] == 1 for r in got)
    assert all(a["high"] == b["low"] for a, b in zip(got, got[1:])) and (not got or not sum(sizes) or got[-1]["high"] == source_schedule.MODULUS)
    assert n_slots == pytest.approx(sum(t * r["blocks"] / r["source_size"] for t, r in zip(want, got) if r["source_size"]), abs=1)


def test_mix_is_near_its_targets_and_repeats(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 200)), rng.choice(["a", "b", "c", "d", None])) for i in range(400)]
    rows += [(None, "x " * 3000, "a"), (7, "y y", "b"), (7, "y y", "b"), (900, None, "z")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, size int")
    out, slots = source_schedule.schedule(df)
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    for no in {r["source_no"] for r in got}:
        own = [r for r in got if r["source_no"] == no]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 4 * 128
    pick = lambda x: sorted(((r["doc_id"] or -1, r["size"], r["taken"]) for r in x), key=str)
    assert pick(source_schedule.schedule(df)[0].collect()) == pick(got)
    # a low-discrepancy schedule: any stretch of slots holds each source in proportion
    order = [r["source_no"] for r in slots.orderBy("slot").collect()]
    for no in set(order):
        share = order.count(no) / len(order)
        assert abs(order[: len(order) // 2].count(no) - share * (len(order) // 2)) <= 4
    assert source_schedule.schedule(df.limit(0))[0].count() == 0


@pytest.fixture(scope="module")
def licence_model():
    return license_model.train()


def licences_by_force(text, model, least=0.5, alike=0.75):
    """(family, probability, similarity) of each confirmed passage, in plain Python."""
    m, out = license_model, []
    if not re.search(m.MARK, text or ""):
        return out
    mark = re.compile("(?i)^(?:" + m.MARKS.replace(" commons", "").replace("eclipse public", "eclipse").replace("boost software", "boost").replace("cc[ -]by", "cc") + ")")
    weights = dict(model.weights)
    for piece in re.split(m.PIECES, text):
        if not re.search(m.MARK, piece):
            continue
        words, spans = m.words_of(piece), []
        for i in [i for i, w in enumerate(words) if mark.search(w)]:
            lo, hi = max(i - m.CONTEXT, 0), i + m.CONTEXT + 1
            if spans and lo <= spans[-1][1]:
                spans[-1] = (spans[-1][0], hi)
            else:
                spans.append((lo, hi))
        for lo, hi in spans:
            w = words[lo:hi]
            z = (np.array(model.bias) + sum(np.array(weights[g]) for g in m.ngrams(w) if g in weights)) / model.temperature
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            family = model.families[int(p.argmax())]
            own = m.ngrams(w, 2, 2)
            held = [(len(own & m.ngrams(m.words_of(t), 2, 2)) / min(len(m.ngrams(m.words_of(t), 2, 2)), max(len(own), 4)), f) for f, t, _ in m.notices() if t not in m.PROSE and len(m.words_of(t)) > 1]
            mine = max((h for h, f in held if f == family), default=0)
            if family != "unknown" and p.max() >= least and mine >= alike and mine >= max(h for h, _ in held):
                out.append((family, round(float(p.max()), 6), round(mine, 6)))
    return sorted(out)


def test_licences_equal_brute_force(spark, licence_model):
    rng = random.Random(9)
    plain = lambda: " ".join(rng.choice("the of and house river stone light under this version license permission copyright GNU".split()) for _ in range(12)).capitalize() + "."
    texts = ["\n".join([plain(), plain(), t, plain()]) for f, t, _ in license_model.notices()[::3]]
    texts += [license_model.PROSE[i] + " " + license_model.PROSE[i + 1] for i in range(0, 20, 2)] + [" ".join([*["word"] * 40, "Released under the MIT License"] * 5), "MIT License\n\nCopyright (c) 2020 Jane Doe"]
    texts += [None, "", "word " * 50_000, "license " * 3_000, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, row int, license string")
    passages, out = license_model.scan(df, licence_model)
    want = [licences_by_force(t, licence_model) for t in texts]
    number = {r["row"]: r["doc_id"] for r in out.collect()}
    got = [[] for _ in texts]
    for r in passages.collect():
        got[number[r["row"]]].append((r["family"], round(r["probability"], 6), round(r["similarity"], 6)))
    assert [sorted(g) for g in got] == want and sum(map(len, want)) > 50
    named = {r["doc_id"]: (r["license"], r["n_paragraphs"]) for r in out.collect()}
    assert all(named[i] == ((max((p, s, f) for f, p, s in w)[2] if w else "unknown"), len(w)) for i, w in enumerate(want))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


#: Notices in words that no template has, by family.
WRAPPED_MIT = """// Permission is hereby granted, free of charge, to any person obtaining a copy
// of this software and associated documentation files (the "Software"), to deal
// in the Software without restriction, including without limitation the rights
// to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
// copies of the Software, and to permit persons to do so."""
UNSEEN = [
    ("mit", "Copyright (c) 2020 Jane Doe. Released under the MIT License."), ("mit", "The sources may be used by everybody under the MIT license"), ("mit", WRAPPED_MIT), ("mit", "This is some software.\n\nMIT License\n\nCopyright 2021 Joe"),
    ("bsd", " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:"), ("apache-2.0", "Apache License, Version 2.0 applies to all of it, and it was licensed under the Apache License in 2011"),
    ("gpl", "It is free software and released under the GNU General Public License"), ("lgpl", "It is free software and released under the GNU Lesser General Public License"), ("agpl", "The server is released under the GNU Affero General Public License"),
    ("cc-by-sa", "All texts are licensed under CC BY-SA 4.0 unless noted"), ("cc-by", "All texts are licensed under CC BY 4.0 unless noted"), ("cc-by-nc", "All texts are licensed under CC BY-NC 4.0 unless noted"), ("isc", "You may copy it, for it is licensed under the ISC License"),
    ("zlib", "It comes under the zlib License like the library"), ("epl-or-unknown", "# SPDX-License-Identifier: EPL-2.0"), ("mit", "# SPDX-License-Identifier: MIT"), ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this"),
]
NONE = ["Licensed under the EUPL, Version 1.2 or later", "SPDX-License-Identifier: CDDL-1.0", "All rights reserved by the MIT press", "He lost his licence in the GNU valley", "Fonts are released under the SIL Open Font License", "This text is licensed under CC BY-NC-ND 4.0", "released under the Foo License", "Permission to land was granted to the Apache pilot without any warranty", "The Mozilla foundation and the BSD systems hold copyright"]


def test_licences_in_other_words_and_near_unknowns(spark, licence_model):
    rows = [(i, t) for i, (_, t) in enumerate(UNSEEN)] + [(100 + i, t) for i, t in enumerate(NONE)] + [(300, None), (None, "Released under the MIT License."), (301, "released under the mit license"), (301, "released under the mit license")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["license"]) for r in license_model.scan(df, licence_model)[1].collect()]
    named = {i: f for i, f in got if i is not None}
    wrong = [(f, named[i], t) for i, (f, t) in enumerate(UNSEEN) if named[i] != f and named[i] not in f.split("-or-")]
    assert not wrong, wrong
    assert {named[100 + i] for i in range(len(NONE))} == {"unknown"}, [(t, named[100 + i]) for i, t in enumerate(NONE)]
    assert len(got) == len(rows) and named[300] == "unknown" and named[301] == "mit" and [f for i, f in got if i is None] == ["mit"]
    assert license_model.scan(df.limit(0), licence_model)[1].count() == 0


def test_common_notices_stay_found(spark, licence_model):
    """What is found in a text does not depend on how common it is."""
    df = spark.createDataFrame([(i, f"Copyright {i} Jane. Released under the MIT License.") for i in range(500)], "doc_id long, text string")
    assert license_model.scan(df, licence_model)[1].filter("license = 'mit'").count() == 500


def test_notices_without_marks_are_found(spark, licence_model):
    """Every place where words of a notice stand is looked at, with marks near it or without."""
    anyone = next(t for f, t, _ in license_model.notices() if t.startswith("Anyone is free to copy"))
    binary = "In source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    far = " ".join(["word"] * 60)
    texts = [anyone, f"{far} {anyone} {far}", f"license {far} {anyone[:-1]} {far} licence {far} {anyone}", f"He lost his license there {anyone}", binary, "of the house and the river, in the light of the stone", f"{far} to any of the {far}", "any later version", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["n_paragraphs"]) for r in license_model.scan(df, licence_model)[1].collect()}
    assert [got[i] for i in range(len(texts))] == [("unlicense", 1), ("unlicense", 1), ("unlicense", 2), ("unlicense", 1), ("bsd", 1), *[("unknown", 0)] * 5]


def test_every_word_pair_of_a_notice_is_in_a_passage(spark):
    """Pairs that say something are in a passage with their context, whatever stands around them."""
    m, far = license_model, ["word"] * 60
    pairs = sorted({p for f, t, _ in m.notices() if f != m.UNKNOWN for p in m.ngrams(m.words_of(t), 2, 2) if m.told(p)})
    df = spark.createDataFrame([(i, " ".join([*far[i % 60 :], p, *far])) for i, p in enumerate(pairs)], "row long, text string")
    found = {}
    for r in m.passages_of(df).collect():
        found.setdefault(r["row"], []).append(r["words"])
    missed = [p for i, p in enumerate(pairs) if not any(f" {p} " in f" {' '.join(w)} " and len(w) >= m.CONTEXT + 2 for w in found.get(i, []))]
    assert len(pairs) > 400 and not missed, missed
    # the others alone do not confirm a notice around which there is some context
    for p in [m.ngrams(m.words_of(t), 2, 2) for f, t, _ in m.notices() if f != m.UNKNOWN and len(m.words_of(t)) > 1]:
        assert sum(not m.told(x) for x in p) < 0.75 * min(len(p), m.CONTEXT)
    # a piece of stop words alone is a passage where they could confirm it
    dense = spark.createDataFrame([(0, "with this is under the"), (1, " ".join([*far, "with this is under the", *far]))], "row long, text string")
    assert [(r["row"], r["words"]) for r in m.passages_of(dense).collect()] == [(0, ["with", "this", "is", "under", "the"])]


def test_held_out_notices_are_told_apart(licence_model):
    """The first fit, which has not seen the held-out notices, names their families."""
    rng, m = random.Random(1), license_model
    rows = [(m.words_of(t), f, h) for f, t, h in m.notices()]
    vocab = {g: i for i, g in enumerate(sorted({g for v, _, h in rows if not h for g in m.ngrams(v)}))}
    families = [*sorted(m.FAMILIES), "unknown"]
    x = np.zeros((len(rows), len(vocab)), np.float32)
    for i, (v, _, _) in enumerate(rows):
        x[i, [vocab[g] for g in m.ngrams(v) if g in vocab]] = 1
    y, held = np.array([families.index(f) for _, f, _ in rows]), np.array([h for _, _, h in rows])
    w, b = m.regression(x[~held], y[~held], len(families), 100)
    assert ((x[held] @ w + b).argmax(axis=1) == y[held]).mean() >= 0.9 and held.sum() > 60
    del rng


def test_words_of_equals_its_spark_form(spark):
    texts = ["GPL-3.0-or-later, (the \"License\")", "", "--x.. .y", "É a.b-c", "A.B"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(license_model.word_column(F.col("t"))).collect()
    assert [r[0] for r in got] == [license_model.words_of(t) for t in texts]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(10)
    vocab = [f"w{i}" for i in range(400)]
    sentence = lambda: " ".join(rng.choice(vocab) for _ in range(15)).capitalize() + "."
    good = [(i, "\n".join(sentence() for _ in range(6))) for i in range(80)]
    bad = [(100 + i, " ".join(w.upper() + "###" for w in sentence().split() * 5)) for i in range(40)]
    loops = [(200, "\n".join([sentence()] * 30))]
    copies = [(300 + i, t) for i, (_, t) in enumerate(good[:5])]
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in good + bad + loops + copies] + [(None, None, None, None, None)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    a = cp.classify(spark, docs, d).persist()
    ids = {r["doc_id"] for r in a.collect()}
    assert {i for i, _ in good} <= ids and not {i for i, _ in bad} & ids and a.columns == cp.COLUMNS
    b = cp.rules(spark, a, d).persist()
    assert {r["doc_id"] for r in b.collect()} == ids - {200, None}
    c = cp.distinct(spark, b, d).persist()
    assert {r["doc_id"] for r in c.collect()} == {i for i, _ in good}
    e = cp.mix(spark, c, d)
    assert e.columns == cp.COLUMNS and {r["doc_id"] for r in e.collect()} <= {i for i, _ in good}
    out = cp.run(spark, d).collect()
    assert len(out) == e.count() and all(r["lossless"] for r in out)
    assert cp.pieces(spark, docs.limit(0), d).count() == 0 and cp.mix(spark, docs.limit(0), d).count() == 0


def test_pipeline_keeps_rows_with_null_and_repeated_ids(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(11)
    text = lambda: " ".join(rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(60))
    texts = [text() for _ in range(8)]
    # an id on a copy of a smaller id's text and on a text of its own, equal rows, null ids
    rows = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (3, texts[2]), (3, texts[2]), (None, texts[0]), (None, texts[3]), (None, texts[3]), (None, texts[4])]
    rows += [(4, texts[5]), (4, texts[6] + " " + texts[6]), (5, texts[7])]
    df = spark.createDataFrame([(i, t, "en", None if t == texts[4] else "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.distinct(spark, df, "").collect()
    assert sorted(r["text"] for r in kept) == sorted({t for _, t in rows})
    assert {r["doc_id"] for r in kept if r["text"] == texts[0]} == {1}
    df = spark.createDataFrame(kept, df.schema).coalesce(1)
    mixed = cp.mix(spark, df, "").collect()
    keyed = df.withColumn("k", F.col("text"))
    want = {r["k"]: int(r["taken"] / r["size"] + 0.5) for r in source_schedule.schedule(keyed, key="k")[0].collect()}
    assert {t: n for t, n in want.items() if n} == {t: sum(r["text"] == t for r in mixed) for t in {r["text"] for r in mixed}}
    assert any(r["doc_id"] is None for r in mixed)
    none = spark.createDataFrame([(1, None, "en", "a", 0), (None, "", "en", None, 0), (2, "a b", "en", "a", 3)], df.schema)
    assert sorted(r["text"] or "" for r in cp.mix(spark, none, "").collect()) == ["", "", "a b"]
    # copies that the mix makes are cut on their own
    twice = df.filter("text = '" + texts[5] + "'")
    out = cp.pieces(spark, twice.unionByName(twice), "").collect()
    assert len(out) == 2 and all(r["lossless"] for r in out) and out[0]["pieces"] != out[1]["pieces"]


def rules_by_force(text):
    """The base rule and the limits of repeats, by counting windows."""
    w = (text or "").encode().split()
    n = len(w)

    def repeated(span):
        windows = [tuple(w[i : i + span]) for i in range(n - span + 1)]
        often = Counter(windows)
        return {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(span)}

    limits = quality_rules.Limits()
    if n < limits.min_words or 100 * len(repeated(limits.min_repeat)) > limits.max_base_percent * n:
        return False
    return 100 * len(repeated(limits.span)) <= limits.max_percent * n and not repeated(limits.max_longest + 1)


def mix_by_force(rows, block=128):
    """How often each of (doc_id, text, source) stands, from slots and words one by one."""
    size = [len((t or "").encode().split()) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    own = [[i for i, r in enumerate(rows) if r[2] == s] for s in names]
    total = [sum(size[i] for i in o) for o in own]
    goal = source_schedule.targets(total, [(5, 2, 1)[k % 3] for k in range(len(names))])
    blocks = [max(1, (2 * t + block) // (2 * block)) if t else 0 for t in total]
    slots = [int(g * b / t * 1e6) if t else 0 for g, b, t in zip(goal, blocks, total)]
    ends = [sum(slots[:k]) * source_schedule.MODULUS // max(1, sum(slots)) for k in range(len(slots) + 1)]
    rank, times = Counter(), Counter()
    for k in range((sum(slots) + 500_000) // 1_000_000):
        point = k % source_schedule.MODULUS * source_schedule.STEP % source_schedule.MODULUS
        s = next(j for j in range(len(names)) if ends[j] <= point < ends[j + 1])
        if rank[s] < 3 * blocks[s]:
            times[s, rank[s] % blocks[s]] += 1
        rank[s] += 1
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    out = [1] * len(rows)
    for s, o in enumerate(own):
        at = 0
        for i in sorted(o, key=lambda i: (md5("mix" + (str(rows[i][0]) if rows[i][0] is not None else md5(rows[i][1]))), md5(rows[i][1]))):
            word_block = lambda x, s=s: next(b for b in range(blocks[s]) if b * total[s] // blocks[s] <= x < (b + 1) * total[s] // blocks[s])
            taken = sum(times[s, word_block(x)] for x in range(at, at + size[i]))
            out[i] = int(taken / size[i] + 0.5) if size[i] else 1
            at += size[i]
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    """The whole pipeline against plain Python, from the texts to the rows that come out."""
    import sentencepiece

    import corpus_pipeline as cp
    from telestream.llm import merge_dropout, quality_crf

    rng = random.Random(15)
    vocab = [f"w{i}" for i in range(300)]
    sentence = lambda: " ".join(rng.choice(vocab) for _ in range(12)).capitalize() + "."
    texts = ["\n".join(sentence() for _ in range(rng.randrange(2, 9))) for _ in range(70)]
    texts += [" ".join(w.upper() + "###" for w in sentence().split() * 4) for _ in range(30)]
    near = [t.split() for t in texts[:6]]
    texts += [" ".join([*w[:10], "changed", *w[11:]]) for w in near] + texts[10:14] + ["\n".join([sentence()] * 25), "too short", "", texts[20] + " " + texts[20]]
    rows = [(i, t, "en", (None, "b", "a", "é", "B")[i % 5], len(t)) for i, t in enumerate(texts)]
    d = str(tmp_path)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{d}/documents.parquet")
    labels = spark.createDataFrame([(i, int("###" not in t), 0) for i, t in enumerate(texts[:100])], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{d}/labels.parquet")
    model = quality_crf.train(spark.read.parquet(f"{d}/documents.parquet"), labels)
    kept = [r for r in rows if model.scores([quality_crf.describe(r[1].encode())])[0] >= 0.7]
    kept = [r for r in kept if rules_by_force(r[1])]
    roots = components_by_force([shingle_set(r[1], 5) for r in kept], 80)
    kept = [r for i, r in enumerate(kept) if roots[i] == i]
    want = Counter({r[0]: n for r, n in zip(kept, mix_by_force([(r[0], r[1], r[3]) for r in kept])) if n})
    out = cp.run(spark, d).collect()
    assert Counter(r["doc_id"] for r in out) == want and 40 < len(want) < 80 and max(want.values()) > 1
    sp = sentencepiece.SentencePieceProcessor(model_file=cp.tokenizer(cp.PIECE_BPE))
    known = dict((r[0], r[1]) for r in rows)
    plain = merge_dropout.pieces(cp.tokenizer(cp.PIECE_BPE))
    for r in out:
        assert plain.decode(r["pieces"]) == known[r["doc_id"]] and r["lossless"] and r["n_pieces"] >= len(sp.encode(known[r["doc_id"]])) * 0.9
