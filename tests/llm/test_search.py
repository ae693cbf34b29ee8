"""Exact top-k and lexical search against plain code."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perennia.llm import lexical, vafile

VECTORS = "vec_id long, embedding array<float>, label int, id string, score double"


def best(rows, k, asks):
    """query: [(id, score)] by comparing everything; rows of one id count once."""
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, a in whole:
        if not asks(q):
            continue
        held = out.setdefault(q, {})
        for c, b in whole:
            if c != q and len(a) == len(b):
                score = max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b))))
                held[c] = max(held.get(c, score), score)
    return {q: sorted(((c, s) for c, s in held.items()), key=lambda x: (-x[1], x[0]))[:k] for q, held in out.items() if held}


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return out


def made(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows], VECTORS).repartition(3)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 12), st.sampled_from([3, 70, 10**6, 2**40]))
def test_bounds_hold(seed, dim, size):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-size, size + 1, (200, dim))
    grid = vafile.grid_of(vectors[: 200 if size == 3 else 50], vectors.min(axis=0), vectors.max(axis=0))
    cells = grid.numbers(vectors)
    low, high = grid.bounds(vectors[:20].astype(float), cells)
    exact = np.clip((vectors[:20].astype(object) @ vectors.astype(object).T).astype(float), vafile.LEAST, vafile.MOST)
    assert (low <= exact).all() and (exact <= high).all()
    if size == 3:  # cells of one value each
        assert (high - low < 1e-6).all()


def test_scan_keeps_the_best_and_leaves_most(monkeypatch):
    monkeypatch.setattr(vafile, "TILE", 64)
    rng = np.random.default_rng(3)
    vectors = np.floor(64 * rng.normal(0, 0.125, (3000, 64))).astype(np.int64)
    grid = vafile.grid_of(vectors[:1000], vectors.min(axis=0), vectors.max(axis=0))
    ids = np.arange(3000)
    row, col, _, _ = vafile.survivors(grid, vectors[:30].astype(float), ids[:30], grid.numbers(vectors), ids, ids >= 0, 20)
    kept = set(zip(row.tolist(), col.tolist()))
    assert len(kept) < 30 * 3000 / 8
    exact = vectors[:30] @ vectors.T
    for q in range(30):
        order = [c for c in np.lexsort((ids, -exact[q])).tolist() if c != q][:20]
        assert {(q, c) for c in order} <= kept


@pytest.mark.parametrize("cells", [2, 64])
def test_top_k_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(vafile, "CELLS", cells)
    monkeypatch.setattr(vafile, "CANDIDATE_BLOCK", 100)
    monkeypatch.setattr(vafile, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 16).tolist()) for i in range(400)]
    rows += [(500 + i, rows[20][1]) for i in range(60)]  # ties
    rows += [(5, rows[9][1]), (5, rows[9][1]), (20, rows[3][1]), (40, rows[40][1])]  # ids that occur again
    rows += [(600, None), (None, rows[0][1]), (620, [float("nan")] * 16), (640, [None] * 16), (660, []), (661, []), (680, [0.0] * 16), (700, [1.0])]
    assert found(vafile.top_k(made(spark, rows), F.col("vec_id") % 20 == 0, k=7)) == best(rows, 7, lambda i: i % 20 == 0)


def test_large_numbers_and_few_candidates(spark):
    rows = [(0, [3e38, -1.0]), (1, [2e17, 5.0]), (2, [-1e17, 2.0]), (20, [0.0, 1.0]), (3, [1e4, 1e4])]
    got = found(vafile.top_k(made(spark, rows), F.col("vec_id") % 20 == 0, k=3))
    assert [c for c, _ in got[20]] == [3, 1, 2] and len(got[0]) == 3
    assert found(vafile.top_k(made(spark, rows[:1]), F.col("vec_id") % 20 == 0)) == {}
    assert vafile.top_k(made(spark, rows).limit(0), F.col("vec_id") % 20 == 0).collect() == []


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k):
    counts = [(id, Counter(words(text)), len(words(text))) for id, text in docs]
    n_docs, length = sum(n > 0 for *_, n in counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for id, text in items:
        asked.setdefault(id, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for id, c, n in counts:
            if n:
                m = 100 - 50 + (50 * n * n_docs) // length
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
                if s > 0:
                    scored.append((-s, id is None, id or 0, id))
        out += [(item, r, e[3], -e[0]) for r, e in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ITEMS = "item_id long, text string, doc_id string, score long"


def asked(spark, items):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in items], ITEMS)


TEXTS = ["The cat sat. the CAT!", "Élan élan ÉLAN x-ray", "a b a b a", "cat", "\x00cat\x00dog", None, "", "... !!", "straße Straße 12ab", "日本 語 cat"]


def test_automaton_counts_whole_words():
    terms = ["a", "aa", "cat", "é", "日本", "a1"]
    automaton = lexical.Automaton(terms)
    for text in ("A aa-aaa a,a cat_cat\tcats É é 日本 日本語 A1 a1", "", "a" * 99, " a " * 50):
        n, counts = automaton.counts(text)
        want = Counter(words(text))
        assert n == sum(want.values()) and {terms[k]: v for k, v in counts.items()} == {t: want[t] for t in terms if want[t]}


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_terms_of_any_text(text):
    n, counts = lexical.Automaton(sorted(set(words(text)) | {"a"})).counts(text)
    assert n == len(words(text)) == sum(v for v in counts.values())


@pytest.mark.parametrize("k", [3, 50])
def test_search_equals_plain_code(spark, make_docs, monkeypatch, k):
    docs = [(i, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(None, "cat dog"), (7, "cat again"), (99, "cat " * 50_000)]
    items = [(1, "Cat dog élan"), (2, None), (3, ""), (4, "nowhere"), (None, "straße b"), (1, "x"), (5, "日本 a a"), (5, "日本 a a")]
    want = ranked(docs, items, k)
    frame = make_docs(docs).repartition(4)
    assert sorted(map(tuple, lexical.search(frame, asked(spark, items), k).collect()), key=str) == want
    monkeypatch.setattr(lexical, "PAIRS", 4)  # several automata
    monkeypatch.setattr(lexical, "AT_ONCE", 5)
    assert sorted(map(tuple, lexical.search(frame, asked(spark, items), k).collect()), key=str) == want


def test_search_of_nothing(spark, make_docs):
    nothing, one = make_docs([(0, "x")]).limit(0), asked(spark, [(1, "cat")])
    for docs, items in ((nothing, one), (make_docs([(0, "cat")]), one.limit(0)), (make_docs([(0, None)]), one)):
        assert lexical.search(docs, items).collect() == []
