"""Near-duplicates and neighbours against brute force."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest

from perennia.llm import caps, knn, minhash
from perennia.llm.catalog import QUERIES, SQL
from perennia.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def groups_of(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    source = random.Random(3)
    chain = [(k, k + 1) for k in range(0, 60)]
    loose = [(source.randrange(100, 200), source.randrange(100, 200)) for _ in range(60)]
    star = [(200, k) for k in range(201, 260)]
    links = chain + loose + star + [(7, 7), (3, 4), (4, 3)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = groups_of(260, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def brute_force(texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    links = []
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    return [len(s) for s in sets], groups_of(len(texts), links)


@pytest.fixture(scope="module")
def corpus():
    source = random.Random(1)
    words = ["".join(source.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    passage = [source.choice(words) for _ in range(60)]
    texts = []
    for _ in range(25):  # families of edited copies, and documents that share a passage
        base = [source.choice(words) for _ in range(source.randrange(5, 150))]
        texts.append(" ".join(base))
        for _ in range(source.randrange(0, 6)):
            copy = list(base)
            for _ in range(source.randrange(0, 8)):
                copy[source.randrange(len(copy))] = source.choice(words)
            texts.append(" ".join(copy).upper())
        texts.append(" ".join(passage + base[: source.randrange(1, 30)]))
    return texts + ["", " \t\n", "one", "ONE", "two words", "É é", "é É", None] + texts[:5]


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(make_docs, corpus, width):
    sizes, roots = brute_force(corpus, width, 80)
    rows = minhash.near_duplicates(make_docs(list(enumerate(corpus))), width=width).collect()
    assert len(rows) == len(corpus)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got == {i: (sizes[i], roots[i], roots[i] == i) for i in range(len(corpus))}


def test_large_buckets_are_cut_into_cells(make_docs, corpus, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", 3)
    _, roots = brute_force(corpus, 4, 80)
    rows = minhash.near_duplicates(make_docs(list(enumerate(corpus))), width=4).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(roots))


def test_near_duplicates_odd_rows(make_docs):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(5, text), (5, text), (3, text + " end"), (None, text), (None, None), (9, None), (9, "other text here now")]
    got = sorted((tuple(r) for r in minhash.near_duplicates(make_docs(rows), width=4).collect()), key=str)
    assert got == sorted(
        [(5, 47, 3, False), (5, 47, 3, False), (3, 48, 3, True), (None, 47, None, True), (None, 0, None, True), (9, 0, 9, True), (9, 1, 9, True)],
        key=str,
    )
    assert minhash.near_duplicates(make_docs([]).limit(0)).count() == 0


def test_shared_counts():
    source = np.random.default_rng(0)
    sets = [np.unique(source.integers(0, 6000, 4000).astype(np.uint64)) for _ in range(9)] + [np.array([1], np.uint64)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    off = ~np.eye(10, dtype=bool)
    assert (minhash._shared(sets) == np.array(want))[off].all()


def table_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, dim string, score string")


@pytest.fixture(scope="module")
def vectors():
    source = np.random.default_rng(2)
    base = source.normal(size=(40, 16)).astype(np.float32)
    near = (base[:20, None, :] + 0.05 * source.normal(size=(20, 5, 16))).reshape(-1, 16).astype(np.float32)
    rows = [(k, v.tolist(), k % 3, "a", "b") for k, v in enumerate(np.vstack([base, near, base[:4]]))]
    n = len(rows)
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [math.nan] * 16, [math.inf] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + k, v, 1, "a", "b") for k, v in enumerate(odd)]
    return rows + [(None, rows[0][1], 0, "a", "b"), (n + 20, rows[0][1], None, "a", "b"), rows[1], rows[1]]


def valid(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_duplicate_vectors(spark, vectors):
    rows = [r for r in dict.fromkeys((r[0], tuple(r[1]) if r[1] is not None else None, r[2]) for r in vectors)]
    links = {}
    for i, a, la in rows:
        for j, b, lb in rows:
            if i is None or j is None or i == j or la is None or la != lb or not valid(a) or not valid(b) or len(a) != len(b):
                continue
            x, y = np.array(a, float), np.array(b, float)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links.setdefault(i, set()).add(j)
    most = max(r[0] for r in rows if r[0] is not None) + 1
    roots = groups_of(most, [(a, b) for a, own in links.items() for b in own])
    got = caps.near_duplicates(table_of(spark, vectors)).collect()
    assert len(got) == len(vectors)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            want = (len(links.get(r.vec_id, ())), roots[r.vec_id], roots[r.vec_id] == r.vec_id)
            assert (r.n_links, r.component_id, r.kept) == want
    assert caps.near_duplicates(table_of(spark, [])).count() == 0


def test_vector_blocks(spark, vectors, monkeypatch):
    want = sorted(map(str, caps.near_duplicates(table_of(spark, vectors)).collect()))
    monkeypatch.setattr(caps, "BLOCK", 2)
    assert sorted(map(str, caps.near_duplicates(table_of(spark, vectors)).collect())) == want


def plain_distance(a, b):
    total = 0.0  # added one by one; sum() would compensate
    for x, y in zip(a, b, strict=True):
        total += (x - y) ** 2
    return math.sqrt(total)


@pytest.mark.parametrize("blocks", [(512, 8192, 1024), (3, 20, 7)])
def test_nearest(spark, vectors, monkeypatch, blocks):
    for name, value in zip(("QUERY_BLOCK", "CANDIDATE_BLOCK", "TILE"), blocks, strict=True):
        monkeypatch.setattr(knn, name, value)
    from pyspark.sql import functions as F

    got = knn.nearest(table_of(spark, vectors), F.col("vec_id") % 10 == 0, k=7).collect()
    usable = {r[0]: r[1] for r in vectors if r[0] is not None and valid(r[1])}
    want = {}
    for q, a in usable.items():
        if q % 10 == 0:
            near = sorted((plain_distance(a, b), i) for i, b in usable.items() if i != q and len(b) == len(a))
            for rank, (d, i) in enumerate(near[:7], 1):
                want[q, rank] = (i, d)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == want
    assert knn.nearest(table_of(spark, []), F.col("vec_id") % 10 == 0).count() == 0


def test_repeated_ids_take_one_place(spark):
    source = np.random.default_rng(6)
    rows = [(k, source.normal(size=8).tolist()) for k in range(40)] * 2  # every row twice
    rows += [(1, (np.array(rows[0][1]) + 0.001 * k).tolist()) for k in range(1, 15)]  # an id with many rows near a query
    rows = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    from pyspark.sql import functions as F

    got = knn.nearest(table_of(spark, [(*r, 0, "", "") for r in rows]), F.col("vec_id") % 20 == 0, k=10).collect()
    want = {}
    for q in (0, 20):
        near = {}
        for i, b in rows:
            if i != q:
                near[i] = min(near.get(i, math.inf), plain_distance(rows[q][1], b))
        for rank, (d, i) in enumerate(sorted((d, i) for i, d in near.items())[:10], 1):
            want[q, rank] = (i, d)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == want
    # within a cell, over several tiles
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    found = knn.nearest_in_cell(np.array([0]), vectors[:1], ids, vectors, 10)
    assert sorted((d, i) for _, i, d in found) == [(want[0, r][1], want[0, r][0]) for r in range(1, 11)]


def test_quantisation_bounds_hold():
    source = np.random.default_rng(0)
    a, b = source.normal(size=(50, 33)) * 10.0 ** source.integers(-3, 4, (50, 1)), source.normal(size=(60, 33))
    low, high = knn.tile_bounds(knn.quantised(a), knn.quantised(b))
    exact = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    assert (low <= exact).all() and (exact <= high).all()


def test_decoding_lists_all_directions():
    source = np.random.default_rng(1)
    x = source.normal(size=(20, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation, books = caps.codes(32)
    y = x @ rotation
    scores = (y[:, :16] @ books[0].T)[:, :, None] + (y[:, 16:] @ books[1].T)[:, None, :]
    for k, found in enumerate(caps.decode(x)):
        over = np.flatnonzero(scores[k].ravel() >= caps.THRESHOLD / np.sqrt(32) * np.sqrt(2))
        assert set(over) <= set(found.tolist()) and (len(over) == len(found) or len(found) == caps.LEAST)


@pytest.mark.parametrize("name", ["op4_nearest_neighbours", "op5_cap_dedup", "op7_warc", "op2_minhash_dedup"])
def test_queries_equal_their_sql(spark, name):
    if name not in SQL:
        pytest.skip("no SQL")
    base = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        base.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    want = base.sql(SQL[name])
    order = [frame.columns.index(c) for c in want.columns]
    assert sorted(str(tuple(r[k] for k in order)) for r in frame.collect()) == sorted(str(tuple(r)) for r in want.fetchall())


def test_an_id_with_different_texts(make_docs):
    """Ids are linked with what any of their texts is similar to, and with nothing else."""
    a, b = (" ".join(f"{x}{i}" for i in range(80)) for x in "ab")
    rows = [(9, a), (9, b), (20, b), (30, b + " more"), (30, b + " more"), (40, "else " * 3), (5, a + " last"), (9, None)]
    for seed in range(3):
        mixed = rows[seed:] + rows[:seed]
        got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in minhash.near_duplicates(make_docs(mixed).repartition(3), width=4).collect()}
        assert got == {(9, 77): 5, (20, 77): 5, (30, 78): 5, (40, 1): 40, (5, 78): 5, (9, 0): 9}


def test_an_id_with_different_vectors(spark):
    rng = np.random.default_rng(8)
    base, other = rng.normal(size=16), rng.normal(size=16)
    near = [(base + 1e-3 * rng.normal(size=16)).tolist() for _ in range(5)]
    rows = [(9, near[0], 1), (9, near[1], 1), (20, near[2], 1), (30, near[3], 1), (30, near[3], 1), (31, near[3], 1)]
    rows += [(9, other.tolist(), 1), (50, (other * 2).tolist(), 1), (60, (-other).tolist(), 1), (70, near[4], 2), (9, near[4], 2)]
    links = {}
    for i, v, label in rows:
        for j, w, other_label in rows:
            cosine = np.dot(v, w) / np.sqrt(np.dot(v, v) * np.dot(w, w))
            if i != j and label == other_label and cosine >= 0.98:
                links.setdefault(i, set()).add(j)
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in caps.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {(i, len(links.get(i, ())), 9 if i != 60 else 60) for i, _, _ in rows}


def test_rounds_of_components_broadcast_nothing(spark):
    from perennia.llm import components as c

    edges = spark.createDataFrame([(2, 1), (3, 2), (5, 4)], "a long, b long")
    for step in (c._large, c._small):
        assert "Broadcast" not in step(edges)._jdf.queryExecution().executedPlan().toString()
    found = {r.node: r.root for r in c.components(edges).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_the_filter_of_needed_texts_makes_no_row_objects(spark, monkeypatch):
    from perennia.llm import minhash

    docs = spark.createDataFrame([(k if k % 7 else None, f"t{k}") for k in range(1, 200)], "doc long, text string")
    monkeypatch.setattr(type(docs), "toPandas", None)
    kept = minhash._needed(docs, docs.filter("doc % 50 = 1").select("doc"), "doc").collect()
    assert {1, 51, 101, 151} <= {r.doc for r in kept} and len(kept) < 10
    assert minhash._needed(docs, docs.filter("doc < 0").select("doc"), "doc").count() == 0
