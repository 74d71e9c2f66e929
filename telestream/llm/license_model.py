"""Licence scan: a trained paragraph classifier in DataFrame functions only.

A text is cut at blank lines and ends of sentences, so that notices that wrap over several
lines stay whole. Every word of every piece is looked at: passages are the stretches of up to
``CONTEXT`` words on both sides of marks, the words with which most notices tell what they
are (``MARKS``: licen-, copyright, SPDX, GNU, ...), and of every other place where two
words of a family's notice stand side by side, since a prediction counts only with such
pairs. A multinomial logistic regression over word 1-, 2- and 3-grams
gives each passage the probability of each licence family and of the unknown class; a
temperature calibrates it. A prediction counts if it is likely enough and the passage holds
most of the word pairs of one of the family's notices, and no notice of another licence
fits better. A notice inside a longer line, or a longer one of which a line is
quoted, is found like one that stands alone.

The model is trained on the driver from the notices below alone: frames filled with the
names of each family, sentences of the licences themselves, and, for the unknown class,
notices of other licences, reservations of rights and prose that speaks of licences.
Nothing is drawn from the corpus, so what is found in a text does not depend on other
texts. The temperature comes from frames and sentences that a first fit has not seen; a
second fit uses all. Weights and notices are fixed tables of some thousand rows, which are
broadcast. Pieces without a mark or a pair have no passage and leave the plan early.

Null and empty texts have no licence. Results are per row of the corpus; repeated rows and
ids get a row each. Of several families in a text the likeliest is named, then the more
similar, then the later by name. An empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

UNKNOWN = "unknown"
#: Names of each family, its identifiers, and sentences of its text (public wording; fixed values).
FAMILIES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "agpl": (
        ["the GNU Affero General Public License", "the GNU AGPL, version 3", "AGPLv3"],
        ["AGPL-3.0-only", "AGPL-3.0-or-later"],
        ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "You should have received a copy of the GNU Affero General Public License along with this program."],
    ),
    "apache-2.0": (
        ["the Apache License, Version 2.0", "the Apache 2.0 license", "the Apache License", "Apache-2.0"],
        ["Apache-2.0"],
        ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.', "See the License for the specific language governing permissions and limitations under the License."],
    ),
    "bsd": (
        ["the BSD License", "the 3-clause BSD license", "a BSD-style license", "the New BSD License"],
        ["BSD-2-Clause", "BSD-3-Clause"],
        ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    ),
    "boost": (["the Boost Software License, Version 1.0", "the Boost Software License"], ["BSL-1.0"], ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"]),
    "cc-by": (["CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "the Creative Commons Attribution License"], ["CC-BY-4.0", "CC-BY-3.0"], ["You are free to copy and adapt this work under a Creative Commons Attribution 4.0 International License."]),
    "cc-by-nc": (["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License", "the Creative Commons Attribution-NonCommercial License"], ["CC-BY-NC-4.0", "CC-BY-NC-3.0"], ["This work may be shared for non-commercial purposes under a Creative Commons Attribution-NonCommercial 4.0 International License."]),
    "cc-by-sa": (["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License", "the Creative Commons Attribution-ShareAlike License"], ["CC-BY-SA-4.0", "CC-BY-SA-3.0"], ["Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply."]),
    "cc0": (["CC0 1.0", "the Creative Commons CC0 1.0 Universal license", "the CC0 1.0 Universal public domain dedication"], ["CC0-1.0"], ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."]),
    "epl": (["the Eclipse Public License v2.0", "the Eclipse Public License, version 2.0", "the Eclipse Public License"], ["EPL-1.0", "EPL-2.0"], ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"]),
    "gpl": (
        ["the GNU General Public License, version 3", "the GNU GPL", "GPLv3", "GPLv2", "the GNU General Public License"],
        ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"],
        ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "You should have received a copy of the GNU General Public License along with this program."],
    ),
    "isc": (["the ISC License", "the ISC license"], ["ISC"], ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."]),
    "lgpl": (
        ["the GNU Lesser General Public License, version 3", "the GNU LGPL", "LGPLv3", "the GNU Lesser General Public License"],
        ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
        ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "You should have received a copy of the GNU Lesser General Public License along with this library."],
    ),
    "mit": (
        ["the MIT License", "the MIT license", "MIT license"],
        ["MIT"],
        ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.', "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    ),
    "mpl-2.0": (["the Mozilla Public License, version 2.0", "the Mozilla Public License, v. 2.0", "the Mozilla Public License"], ["MPL-2.0", "MPL-1.1"], ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"]),
    "unlicense": (["the Unlicense"], ["Unlicense"], ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial."]),
    "zlib": (["the zlib License", "the zlib/libpng license"], ["Zlib"], ["This software is provided 'as-is', without any express or implied warranty.", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"]),
}
#: Other licences by name and identifier: unknown.
OTHERS: tuple[list[str], list[str]] = (
    ["the SIL Open Font License, Version 1.1", "the European Union Public Licence", "the EUPL, Version 1.2", "the Common Development and Distribution License", "the Microsoft Public License", "the Academic Free License", "the Open Software License", "the PostgreSQL License", "the CeCILL license", "the Artistic License 2.0", "the Python Software Foundation License", "the Business Source License 1.1", "the Server Side Public License", "the Elastic License 2.0", "the Open Government Licence v3.0", "a commercial license", "a proprietary license", "the Open Database License", "the University of Illinois/NCSA Open Source License", "the W3C Software License", "CC BY-NC-ND 4.0", "CC BY-NC-SA 4.0", "CC BY-ND 4.0", "its own license", "the same license", "a free license", "the terms of the license agreement"],
    ["OFL-1.1", "EUPL-1.2", "CDDL-1.0", "MS-PL", "AFL-3.0", "OSL-3.0", "PostgreSQL", "CECILL-2.1", "Artistic-2.0", "PSF-2.0", "BUSL-1.1", "SSPL-1.0", "Elastic-2.0", "OGL-UK-3.0", "ODbL-1.0", "NCSA", "W3C", "WTFPL", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0"],
)
#: Sentences with words of licences that grant none of the above: unknown.
PROSE = [
    "The driver lost his license after the accident.", "All rights and duties are listed in the contract.", "A license is required to fish in this lake.", "The software was free of charge for a month.", "Permission to enter the building was granted by the guard.", "The public library is open to any person.",
    "He studied at MIT and at Berkeley.", "All rights reserved.", "Copyright 2020 by the author.", "Copyright (c) 2019 Jane Doe.", "Unauthorized copying of this file is strictly prohibited, proprietary and confidential.", "No part of this publication may be reproduced without the prior written permission of the publisher.",
    "The Apache helicopter landed near the village.", "The Apache web server answers on port 80.", "Mozilla released a new version of its browser.", "The GNU project was announced in 1983.", "A gnu is a large antelope.", "The BSD family of systems began at Berkeley.", "Creative people often work at night.", "The house of commons debated the bill.",
    "The warranty covers parts and labor for two years.", "This product comes without any warranty of fitness.", "The engine has 1600 cc and four valves.", "The state issues a driver's license at sixteen.", "You need permission from your parents.", "The company sells licenses for its software.", "By using this site you accept the license terms.",
    "Ask the copyright holder before you use the picture.", "The license plate was stolen.", "Eclipse is a tool for Java developers.", "The boost in sales came from exports.", "The zlib library compresses data.", "Their license to operate the mine was revoked.", "He has a licence to kill.", "The publisher holds the copyright to the book.", "A general warrant was issued by the court.",
    "Artistic freedom is protected by law.", "Redistribution of wealth was the aim of the reform.", "The land was redistributed among the farmers.", "See the license file for details.", "The text of the license is in the file LICENSE.", "Please read the license agreement before you install the software.",
]
FRAMES = ["{}", "Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "Distributed under {}.", "This project is released under {}.", "Available under the terms of {}.", "Its code is under {}.", "License: {}."]
SPDX = "SPDX-License-Identifier: {}"
#: Words that say nothing about a licence; an n-gram of them alone is no feature.
STOP = frozenset("a an and any are as at be but by can for from has have if in into is it its may must not of on one or other our shall so such than that the their there these this to under was were will with you your".split())
#: How words begin that most notices have one of.
MARKS = "licen|unlicen|sublicen|copyright|copyleft|spdx|redistribut|permission|warrant|unencumbered|creative commons|gnu\\b|[al]?gpl|mozilla|mpl\\b|apache|bsd|cc0|cc[ -]by|eclipse public|boost software"
MARK = f"(?i)(?<![a-z0-9])(?:{MARKS})"
CONTEXT, PER_TASK = 24, 500
SPLIT = r"[^a-z0-9.\-]+"
#: Blank lines and ends of sentences; "v. 2.0" is none.
PIECES = r"\n[ \t]*(?:[/*#;%\-]+[ \t]*)?\n|(?<=[.!?;])(?<!\bv\.)\s+"


def words_of(text: str) -> list[str]:
    """The words of a passage; the Spark form is ``word_column``."""
    return [w for w in (x.strip(".-") for x in re.split(SPLIT, re.sub("[A-Z]", lambda m: m[0].lower(), text))) if w]


def word_column(line: Column) -> Column:
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.transform(F.split(lower, SPLIT), lambda w: F.btrim(w, F.lit(".-"))), lambda w: w != "")


def ngrams(words: list[str], most: int = 3, least: int = 1) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)}


def gram_column(words: Column, n: int) -> Column:
    made = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, made).otherwise(F.array().cast("array<string>"))


def notices() -> list[tuple[str, str, bool]]:
    """(family, notice, held out) of all families and of the unknown class."""
    out = []
    for family, (names, marks, sentences) in [*FAMILIES.items(), (UNKNOWN, (*OTHERS, PROSE))]:
        filled = [(f.format(x), i) for k, x in enumerate(names) for i, f in enumerate(FRAMES)] + [(SPDX.format(x), 0) for x in marks]
        out += [(family, t, i == len(FRAMES) - 3) for t, i in filled] + [(family, t, i % 4 == 3) for i, t in enumerate(sentences)]
    return out


@dataclass(frozen=True)
class Model:
    families: list[str]  # the last is UNKNOWN
    weights: list[tuple[str, list[float]]]
    bias: list[float]
    temperature: float


def variants(words: list[str], n: int, rng: random.Random) -> list[list[str]]:
    """A notice as written, and with words lost or cut off."""
    out = [words]
    for _ in range(n - 1):
        w = [x for x in words if rng.random() > 0.06] or words
        if rng.random() < 0.3 and len(w) > 8:
            at = rng.randrange(0, len(w) // 2)
            w = w[at : at + max(8, int(len(w) * rng.uniform(0.6, 1)))]
        out.append(w)
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def regression(x: np.ndarray, y: np.ndarray, classes: int, rounds: int, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression (Adam) with an L2 penalty; every class weighs alike."""
    weight = (1 / np.bincount(y, minlength=classes).clip(1))[y].astype(np.float32)[:, None] / classes
    w, b = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    goal = np.eye(classes, dtype=np.float32)[y]
    m1, m2 = np.zeros((x.shape[1] + 1, classes), np.float32), np.zeros((x.shape[1] + 1, classes), np.float32)
    for i in range(1, rounds + 1):
        d = (goal - softmax(x @ w + b)) * weight
        g = np.vstack([x.T @ d - decay * w, d.sum(axis=0)])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        step = 0.1 * (m1 / (1 - 0.9**i)) / (np.sqrt(m2 / (1 - 0.99**i)) + 1e-8)
        w, b = w + step[:-1], b + step[-1]
    return w, b


def train(rounds: int = 100, copies: int = 4, seed: int = 9) -> Model:
    """Fits on the notices; the temperature on those that a first fit has not seen."""
    rng, families = random.Random(seed), [*sorted(FAMILIES), UNKNOWN]
    rows = [(v, families.index(f), held) for f, t, held in notices() for v in variants(words_of(t), copies, rng)]
    rows += [([], len(families) - 1, False)]
    vocab = {g: i for i, g in enumerate(sorted({g for v, _, _ in rows for g in ngrams(v) if told(g)}))}
    x = np.zeros((len(rows), len(vocab)), np.float32)
    for i, (v, _, _) in enumerate(rows):
        x[i, [vocab[g] for g in ngrams(v) if g in vocab]] = 1
    y, held = np.array([k for _, k, _ in rows]), np.array([h for _, _, h in rows])
    w, b = regression(x[~held], y[~held], len(families), rounds)
    z = x[held] @ w + b
    share = (1 / np.bincount(y[held], minlength=len(families)).clip(1))[y[held]]
    loss = lambda t: -(np.log(softmax(z / t)[np.arange(len(z)), y[held]] + 1e-12) * share).sum()
    temperature = min((0.25 * 1.1**i for i in range(40)), key=loss)
    w, b = regression(x, y, len(families), rounds)
    return Model(families, [(g, [float(v) for v in w[i]]) for g, i in vocab.items()], [float(v) for v in b], float(temperature))


def told(gram: str) -> bool:
    """Whether an n-gram says something: one of its words is neither a stop word nor a number."""
    return any(w not in STOP and not w.replace(".", "").isdigit() for w in gram.split(" "))


def stretches(at: Column) -> Column:
    """Stretches (lo, hi) of up to ``CONTEXT`` words on both sides of places; those that touch are one."""
    span = "struct<lo: int, hi: int>"

    def step(done: Column, i: Column) -> Column:
        lo, hi = F.greatest(i - CONTEXT, F.lit(0)), i + CONTEXT + 1
        last = F.element_at(done, -1)
        new = F.struct(lo.alias("lo"), hi.alias("hi")).cast(span)
        grown = F.struct(last["lo"].alias("lo"), hi.alias("hi")).cast(span)
        return F.when(F.size(done) == 0, F.array(new)).when(lo <= last["hi"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(new)))

    return F.aggregate(at, F.array().cast(f"array<{span}>"), step)


def passages_of(docs: DataFrame, alike: float = 0.75) -> DataFrame:
    """(row, passage, words) of (row, text): around the marks, and around every other place
    where two words of a notice stand (``passage.more``). Pairs of stop words are places only
    where they are so dense that they alone could confirm the piece."""
    known = sorted(set().union(*[ngrams(words_of(t), 2, 2) for f, t, _ in notices() if f != UNKNOWN]))
    cut = docs.filter("text <> ''").select("row", F.posexplode(F.split("text", PIECES)).alias("piece_no", "piece"))
    words = cut.select("row", "piece_no", F.col("piece").rlike(MARK).alias("marked"), word_column(F.col("piece")).alias("words"))
    # a last word stands alone, which is no pair
    words = words.withColumn("pairs", F.transform("words", lambda w, i: F.concat_ws(" ", w, F.get(F.col("words"), i + 1))))
    words = words.withColumn("known", F.filter(F.transform("pairs", lambda p, i: F.when(p.isin(known), i)), lambda i: i.isNotNull()))
    # two-word marks are found at their first word
    word = lambda w: w.rlike(f"^(?:{MARKS.replace(' commons', '').replace('eclipse public', 'eclipse').replace('boost software', 'boost').replace('cc[ -]by', 'cc')})")
    none = F.array().cast("array<int>")
    marks = F.when(F.col("marked"), F.filter(F.transform("words", lambda w, i: F.when(word(w), i)), lambda i: i.isNotNull())).otherwise(none)
    distinct = lambda places: F.size(F.array_distinct(F.transform(places, lambda i: F.get(F.col("pairs"), i))))
    own = F.greatest(F.size(F.array_distinct(F.slice("pairs", F.lit(1), F.greatest(F.size("pairs") - 1, F.lit(0))))), F.lit(4))
    strong = F.filter("known", lambda i: F.get(F.col("pairs"), i).isin([p for p in known if told(p)]))
    places = F.when(F.size("known") == 0, none).when(distinct(F.col("known")) >= alike * own, F.col("known")).otherwise(strong)
    words = words.select("row", "piece_no", "words", stretches(marks).alias("spans"), places.alias("places"))
    left = F.filter("places", lambda i: ~F.exists("spans", lambda s: (s["lo"] <= i) & (i + 1 < s["hi"])))
    tag = lambda spans, more: F.transform(spans, lambda s: F.struct(s["lo"].alias("lo"), s["hi"].alias("hi"), F.lit(more).alias("more")))
    # a number that is not deterministic keeps filters from being pushed below, where all would be computed again
    words = words.select("row", F.monotonically_increasing_id().alias("piece"), "words", F.concat(tag(F.col("spans"), False), tag(stretches(left), True)).alias("spans"))
    found = words.select("row", "piece", "words", F.explode("spans").alias("s"))
    return found.select("row", F.struct("piece", "s.lo", "s.hi", "s.more").alias("passage"), F.slice("words", F.col("s.lo") + 1, F.col("s.hi") - F.col("s.lo")).alias("words"))


def scan(docs: DataFrame, model: Model, least: float = 0.5, alike: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(passages, documents): each confirmed passage (row, passage, text, family,
    probability, similarity), and each row of ``docs`` with row, doc_id, license,
    probability, similarity, n_paragraphs (its confirmed passages)."""
    spark, ws = docs.sparkSession, Workspace(docs.sparkSession, "licences")
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    k = len(model.families)
    found = ws.table(passages_of(rows, alike), "found")
    # passages are few bytes and much work, so partitions are set by their number
    tasks = max(1, found.count() // PER_TASK)
    found = found.repartition(tasks)
    grams = F.array_distinct(F.concat(F.col("words"), gram_column(F.col("words"), 2), gram_column(F.col("words"), 3)))
    weights = spark.createDataFrame(model.weights, "gram string, w array<double>")
    hits = found.select("row", "passage", F.explode(grams).alias("gram")).join(F.broadcast(weights), "gram")
    sums = hits.groupBy("row", "passage").agg(*[F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(k)])
    logits = F.array(*[(F.col(f"s{i}") + F.lit(model.bias[i])) / F.lit(model.temperature) for i in range(k)])
    scored = sums.withColumn("z", logits).withColumn("top", F.array_max("z"))
    scored = scored.withColumn("p", 1 / F.aggregate("z", F.lit(0.0), lambda a, z: a + F.exp(z - F.col("top"))))
    named = F.element_at(F.array(*[F.lit(f) for f in model.families]), F.array_position("z", F.col("top")).cast("int"))
    scored = scored.select("row", "passage", named.alias("family"), F.col("p").alias("probability")).filter((F.col("family") != UNKNOWN) & (F.col("probability") >= least))
    pairs = [(n, f, ngrams(words_of(t), 2, 2)) for n, (f, t, _) in enumerate(notices()) if t not in PROSE]
    known = spark.createDataFrame([(n, f, len(ps), p) for n, f, ps in pairs for p in sorted(ps)], "notice int, other string, size int, pair string")
    both = scored.join(found, ["row", "passage"]).repartition(tasks)
    # every notice is held against the passage: a fixed number of them. A match is a word
    # pair of both, so matches are counted and no lists are compared
    own = both.withColumn("pairs", F.array_distinct(gram_column(F.col("words"), 2)))
    own = own.select("row", "passage", "family", F.size("pairs").alias("own"), F.explode("pairs").alias("pair"))
    near = own.join(F.broadcast(known), "pair").groupBy("row", "passage", "family", "own", "notice", "other", "size").agg(F.count("*").alias("k"))
    near = near.withColumn("held", F.col("k") / F.least(F.col("size"), F.greatest(F.col("own"), F.lit(4))))
    near = near.groupBy("row", "passage").agg(F.max(F.when(F.col("other") == F.col("family"), F.col("held"))).alias("similarity"), F.max("held").alias("best"))
    near = near.filter((F.col("similarity") >= alike) & (F.col("similarity") >= F.col("best")))
    passages = both.join(near.select("row", "passage", "similarity"), ["row", "passage"])
    # a notice that a passage around marks tells is not counted again
    m = passages.filter("NOT passage.more").select(F.col("passage").alias("by"), F.col("family").alias("told"))
    e, again = F.col("passage"), F.col("by")
    passages = passages.join(m, (e["piece"] == again["piece"]) & e["more"] & (F.col("family") == F.col("told")) & (e["lo"] < again["hi"]) & (again["lo"] < e["hi"]), "left_anti")
    passages = ws.table(passages.select("row", "passage", F.array_join("words", " ").alias("text"), "family", "probability", "similarity"), "passages")
    best = passages.groupBy("row").agg(F.max(F.struct("probability", "similarity", F.col("family"))).alias("best"), F.count("*").alias("n_paragraphs"))
    best = best.select("row", F.col("best.family").alias("license"), F.col("best.probability").alias("probability"), F.col("best.similarity").alias("similarity"), "n_paragraphs")
    out = rows.select("row", "doc_id").join(best, "row", "left")
    return passages, out.select("row", "doc_id", F.coalesce("license", F.lit(UNKNOWN)).alias("license"), "probability", "similarity", F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"))
