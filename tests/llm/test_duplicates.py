"""Near-duplicate documents and vectors against all pairs."""

import re

import numpy as np
import pytest

from railwatch.llm import linking
from railwatch.llm.linking import components, forest, linked_components
from railwatch.llm.minhash import deduplicated, near_duplicates
from railwatch.llm.queries import QUERIES
from railwatch.llm.vectors import near_vectors
from tests.llm.samples import Groups, no_docs, odd_docs

SF = "/root/testdata/sf0.001"


def shingle_set(text, width):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def all_pairs(docs, width, percent=80):
    sets = [(i, shingle_set(t, width)) for i, t in docs]
    groups = Groups()
    for k, (i, x) in enumerate(sets):
        groups.find(i)
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                groups.join(i, j)
    return {i: (len(x), groups.find(i)) for i, x in sets}


@pytest.mark.parametrize("width", [4, 5])
def test_documents_equal_all_pairs(spark, width):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = all_pairs([(r.doc_id, r.text) for r in docs.collect()], width)
    got = {r.doc_id: r for r in near_duplicates(docs, width).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_query_has_its_columns(spark):
    got = QUERIES["op2_minmax_near_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == 200


def test_chains_and_borders(spark):
    words = [f"w{i}" for i in range(103)]
    texts = []
    for k in range(12):  # each differs from the one before in a few words at the end
        texts.append((100 - k, " ".join(words[:100 - 3 * k] + [f"n{k}x{j}" for j in range(3 * k)])))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = all_pairs(texts, 5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 5).collect()}
    assert got == want


def test_odd_documents(spark):
    docs = odd_docs(spark)
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.component_id, r.kept) for r in by[1] + by[2]] == [(1, True), (1, False), (1, False)]
    assert all((r.n_shingles, r.component_id, r.kept) == (0, i, True) for i in (3, 4, 5) for r in by[i])
    assert by[7][0].component_id == 6 and by[9][0].component_id == 8
    assert all(r.component_id is None and not r.kept for r in by[None])
    left = deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 8, 10, 11]
    assert left.where("doc_id IS NULL").count() == 2
    twice = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (6, "q")], "doc_id long, text string")
    assert sorted(r.doc_id for r in deduplicated(twice).collect()) == [5, 6]
    assert near_duplicates(no_docs(spark)).collect() == [] and deduplicated(no_docs(spark)).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(500, 500), (139, 200), (7, 7)]
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.find(x) for a, b in edges for x in (a, b) if (a, b) != (500, 500)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("wide", [8, 64, 1_000])
def test_buckets_lose_no_component(spark, monkeypatch, wide):
    """Members of one bucket link by equal remainders: the first comparison leaves most of them apart."""
    monkeypatch.setattr(linking, "WIDE_BUCKET", wide)
    monkeypatch.setattr(linking, "BLOCK", 32)
    members = spark.range(200).selectExpr("1L AS bucket", "id").union(spark.range(30).selectExpr("2L", "id"))

    def verify(pairs):
        return pairs.where("a % 5 = b % 5").select("a", "b")

    def compare(one, two):
        return np.asarray(one)[:, None] % 5 == np.asarray(two)[None, :] % 5

    found = linked_components(members, verify, lambda ids: ids.selectExpr("id", "id AS item"), compare)
    got = {r.id: r.component for r in found.collect()}
    assert all(got[i] == i % 5 for i in range(200))


def test_forest_connects_what_the_matrix_does():
    rng = np.random.default_rng(2)
    for _ in range(20):
        near = rng.random((15, 11)) < 0.1
        want, got = Groups(), Groups()
        for a, b in zip(*np.nonzero(near), strict=True):
            want.join(int(a), 100 + int(b))
        rows, columns = forest(near)
        assert near[rows, columns].all() and len(rows) < 26
        for a, b in zip(rows, columns, strict=True):
            got.join(int(a), 100 + int(b))
        assert {i: want.find(i) for i in want.above} == {i: got.find(i) for i in want.above}


def cosine_groups(rows):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    groups, links = Groups(), {i: 0 for i, _ in rows}
    for k, (i, x) in enumerate(good):
        for j, y in good[:k]:
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                groups.join(i, j)
                links[i] += 1
                links[j] += 1
    return {i: (links[i], groups.find(i)) for i, _ in rows}


def test_vectors_equal_all_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = cosine_groups([(r.vec_id, r.embedding) for r in rows.collect()])
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(rows).collect()}
    same = sum(got[i] == want[i] for i in want)
    assert len(got) == len(want) and same >= 0.99 * len(want)


def test_recall_at_the_threshold(spark):
    """Pairs of random directions at a cosine just above the threshold, and none below is linked."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(300):
        x, y = rng.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = 0.905 if k % 3 else 0.895
        rows += [(2 * k, x.tolist()), (2 * k + 1, (c * x + np.sqrt(1 - c * c) * y).tolist())]
    got = {r.vec_id: r.n_links for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    above = [got[2 * k] for k in range(300) if k % 3]
    assert sum(above) >= 0.9 * len(above)
    assert not any(got[2 * k] for k in range(0, 300, 3))


def test_large_group_of_vectors(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=16)
    rows = [(i, (centre + 0.02 * rng.normal(size=16)).tolist()) for i in range(700)] + [(1000 + i, centre.tolist()) for i in range(300)]
    rows += [(5000 + i, rng.normal(size=16).tolist()) for i in range(50)]
    want = cosine_groups(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 0), (4, None, 0), (5, [0.0, 0.0], 0), (6, [nan, 1.0], 0), (7, [inf, 1.0], 0),
        (8, [None, 1.0], 0), (9, [], 0), (10, [1.0], 0), (None, [1.0, 0.0], 0), (11, [0.0, 1.0], 0), (11, [0.0, 1.0], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, copies int")
    got = near_vectors(df).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    assert all((by[i].n_links, by[i].component_id) == (3, 1) for i in (1, 2, 3, 10))
    assert all((by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True) for i in (4, 5, 6, 7, 8, 9))
    assert by[11].n_links == 1 and by[None].component_id is None and not by[None].kept
    assert near_vectors(df.where("false")).collect() == []


def test_words_that_only_a_polynomial_takes_for_one(spark):
    """Texts of long words that differ in every place share no shingle."""
    bits = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    other = bits.translate(str.maketrans("ab", "ba"))
    texts = [(1, f"{bits} " * 3 + "c d e"), (2, f"{other} " * 3 + "c d e"), (3, f"{bits} " * 3 + "c d e")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, 4).collect()} == {1: 1, 2: 2, 3: 1}


def test_texts_of_one_id_are_all_compared(spark):
    base = " ".join(f"w{k}" for k in range(100))
    texts = [(5, "some other text of this document entirely"), (5, base + " x"), (7, base + " y"), (9, base)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).where("doc_id > 5").collect()} == {7: 5, 9: 5}


@pytest.mark.parametrize("sample", [1, 256])
def test_largest_buckets_stay_where_they_are(spark, monkeypatch, sample):
    monkeypatch.setattr(linking, "HOT_SAMPLE", sample)
    members = spark.range(2_000).selectExpr("1L AS bucket", "id").union(spark.range(900).selectExpr("id % 400 + 5 AS bucket", "id"))
    got = {(r.bucket, r.id): (r.low, r.n) for r in linking.shared_buckets(members).collect()}
    want = {(1, i): (0, 2_000) for i in range(2_000)} | {(i % 400 + 5, i): (i % 400, 3 if i % 400 < 100 else 2) for i in range(900)}
    assert got == want
