"""Archives by round trip and against Python's own ZIP reader; vectors against brute force."""

import base64
import hashlib
import io
import zipfile

import numpy as np
import pytest

from telestream.llm import sorted_passes, warc_zip
from telestream.llm.warc_zip import ZipRanges, ZipWriter


def archive(members):
    out = io.BytesIO()
    z = ZipWriter(out)
    for name, data in members:
        z.begin(name)
        for i in range(0, len(data), 7):
            z.write(data[i : i + 7])
        z.finish()
    z.close()
    return out.getvalue()


def test_written_archives_open_elsewhere():
    data = archive([("archive/data.warc.gz", b"abc" * 50), ("indexes/index.cdxj", b"x"), ("empty", b"")])
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and z.read("archive/data.warc.gz") == b"abc" * 50 and z.read("empty") == b""
    z = ZipRanges(io.BytesIO(data), len(data))
    assert z.read("archive/data.warc.gz", 3, 6) == b"abcabc" and z.read("empty") == b""
    with pytest.raises(ValueError):
        z.read("indexes/index.cdxj", 0, 2)


def test_reads_archives_of_others():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"12345")
        z.comment = b"a comment PK\x05\x06 with a mark"
        with z.open(zipfile.ZipInfo("big"), "w", force_zip64=True) as f:
            f.write(b"zip64")
        z.writestr("packed", b"x" * 100, zipfile.ZIP_DEFLATED)
    z = ZipRanges(io.BytesIO(out.getvalue()), len(out.getvalue()))
    assert z.read("a", 1, 3) == b"234" and z.read("big") == b"zip64"
    with pytest.raises(ValueError):
        z.read("packed")
    for junk in (b"", b"PK", b"x" * 100):
        with pytest.raises(ValueError):
            ZipRanges(io.BytesIO(junk), len(junk))


def test_pages_round_trip(spark):
    rows = [(1, "http://a/ b\n", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 50_000), (7, "u", "same"), (7, "u", "same"), (None, "u", "one")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload_digest string")
    got = warc_zip.round_trip(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert (by[1]["record_type"], by[1]["refers_to"]) == ("revisit", 7) and by[2]["refers_to"] == 7
    assert [(r["record_type"], r["refers_to"]) for r in got if r["page_id"] == 7] == [("response", None)] * 2
    assert by[3]["refers_to"] == 4 and by[4]["record_type"] == "response" and by[3]["payload_bytes"] == 0
    assert by[5]["payload_bytes"] == 100_000
    for i, _, html in rows:
        assert by[i]["payload_digest"] == base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    assert warc_zip.round_trip(df, least=5).filter("record_type = 'revisit'").count() == 0
    assert warc_zip.round_trip(df.limit(0)).count() == 0


def test_many_archives_and_ranges(spark, tmp_path):
    df = spark.range(60).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 200) AS html", "cast(null AS long) AS refers_to").coalesce(1)
    found = warc_zip.write_archives(df, f"file://{tmp_path}/w", most=1500).persist()
    assert found.count() > 3
    got = warc_zip.read_archives(found, f"file://{tmp_path}/w", per_task=2)
    assert sorted(r["page_id"] for r in got.collect()) == list(range(60))


def test_string_ids_and_long_indexes(spark, tmp_path, monkeypatch):
    rows = [("a b/é", "u", "same"), ("z>", "u", "same"), ("", "u", "x"), ("7", None, None)]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = sorted((r["page_id"] or "", r["record_type"], r["refers_to"]) for r in warc_zip.round_trip(df).collect())
    assert got == [("", "response", None), ("7", "response", None), ("a b/é", "revisit", "z>"), ("z>", "response", None)]
    data = archive([("indexes/index.cdxj", b"".join(b"line %d\n" % i for i in range(500)) + b"end"), ("empty", b"")])
    monkeypatch.setattr(warc_zip, "STRETCH", 37)
    z = ZipRanges(io.BytesIO(data), len(data))
    assert list(z.lines("indexes/index.cdxj")) == [b"line %d" % i for i in range(500)] + [b"end"] and list(z.lines("empty")) == []


def by_force(vectors, least):
    n = len(vectors)
    ok = [v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in vectors]
    link = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]) and np.dot(vectors[i], vectors[j]) / np.linalg.norm(vectors[i]) / np.linalg.norm(vectors[j]) >= least] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in link[i]:
                root[i] = root[j] = min(root[i], root[j])
    return [(len(link[i]), root[i]) for i in range(n)]


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((25, 16))
    made = [[float(x) for x in centres[i % 25] + rng.standard_normal(16) * (0.05 if i % 5 else 1)] for i in range(150)]
    made += [made[0], made[0], [0.0] * 16, None, [float("nan")] * 16, [None] * 16, [1.0] * 3, [float("inf")] * 16, []]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(made)], "vec_id long, embedding array<float>, id int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in sorted_passes.near_duplicates(df, window=2).collect()}
    made = [None if v is None else [None if x is None else float(np.float32(x)) for x in v] for v in made]
    assert [got[i] for i in range(len(made))] == by_force(made, 0.95)


def test_vector_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert sorted_passes.near_duplicates(empty).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0]), (3, None)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in sorted_passes.near_duplicates(same).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), None: (0, None, True), 3: (0, 3, True)}


def crowded_cone(n, seed=5):
    """Vectors around one direction, most pairs of which are a little too far apart, with planted links."""
    rng = np.random.default_rng(seed)
    axis = rng.standard_normal(32)
    axis /= np.linalg.norm(axis)
    made = []
    for i in range(n):
        r = rng.standard_normal(32)
        r -= (r @ axis) * axis
        made.append(np.sqrt(0.9) * axis + np.sqrt(0.1) * r / np.linalg.norm(r))
    for i in range(0, n // 10, 2):
        made[i + 1] = made[i] + 0.02 * rng.standard_normal(32)
    return [[float(np.float32(v)) for v in x] for x in made]


def test_every_length_links(spark):
    made = [[1.0, 2.0, 0.0]] * 5 + [[1.0, 2.0], [1.0, 2.0], [2.0, 4.0], [3.0], [-3.0], [6.0]]
    df = spark.createDataFrame(list(enumerate(made)), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in sorted_passes.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(made))] == by_force(made, 0.95)


def test_an_id_on_several_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0])], "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in sorted_passes.near_duplicates(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_passes_of_a_crowded_region_find_what_brute_force_finds(spark):
    """Small windows force real passes; marked rows get more of them or are compared whole."""
    rng = np.random.default_rng(6)
    made = crowded_cone(400) + [[float(np.float32(v)) for v in rng.standard_normal(32)] for _ in range(800)]
    for i in range(400, 440, 2):
        made[i + 1] = [float(np.float32(v + 0.1 * rng.standard_normal())) for v in made[i]]
    df = spark.createDataFrame(list(enumerate(made)), "vec_id long, embedding array<float>")
    x = np.array(made)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    got = {r["vec_id"]: r["n_links"] for r in sorted_passes.near_duplicates(df, window=4).collect()}
    found = sum(min(got[i], int(near[i].sum())) for i in range(len(made)))
    assert all(got[i] <= near[i].sum() for i in range(len(made))) and found >= 0.98 * near.sum() > 0


def test_passes_grow_with_the_rows():
    k = [sorted_passes.passes_for(n, 64, 0.95, 0.002) for n in (10**4, 10**6, 10**8, 10**9)]
    assert k == sorted(k) and 10 < k[0] < k[-1] < 150
    # simulated: pairs at the threshold among evenly spread rows, one window per pass
    rng = np.random.default_rng(7)
    n, d, window = 20_000, 24, 16
    x = rng.standard_normal((n, d))
    for i in range(0, 400, 2):
        u = x[i] / np.linalg.norm(x[i])
        r = rng.standard_normal(d)
        r -= (r @ u) * u
        x[i + 1] = 0.951 * u + np.sqrt(1 - 0.951**2) * r / np.linalg.norm(r)
    found = np.zeros(200, bool)
    for p in range(sorted_passes.passes_for(n, window, 0.95, 0.002)):
        place = np.empty(n, int)
        place[np.argsort(sorted_passes.keys_of(x, 1, p), kind="stable")] = np.arange(n)
        found |= np.abs(place[0:400:2] - place[1:400:2]) <= window
    assert found.mean() >= 0.985


def test_rounded_forms_bound_the_product():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((200, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, scale, rest = sorted_passes.rounded(x)
    y = q * scale[:, None]
    bound = rest[:, None] * (1 + rest[None, :]) + rest[None, :] + sorted_passes.SLACK
    assert (np.abs(y @ y.T - x @ x.T) <= bound).all()
