"""Encoding against the tokenizers library; packing against its own rules and the lower bound."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perennia.llm import bpe, packing
from perennia.llm.catalog import VOCABULARY


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def codec():
    with open(VOCABULARY, encoding="utf-8") as file:
        return bpe.Codec(file.read())


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "Hello, World!!", "don't we'll I'D", "Straße ÀÉÎ ﬁ Ⅳ ① ²", "日本語のテキスト 漢字", "áb é",
        "x<|endoftext|>y <|startoftext|>", "ΣΑΣ ΟΔΟΣ İstanbul", "a\x1cb\x85c\xa0d e", "12345 3.14 $$$ %%% ### a|b",
        "﻿bom ​zero‍", "🙂🙃👩‍👩‍👧", "tab\tnew\r\nline\x0bvt", "́ start", "ß ẞ ŉ ǆ",
    ],
)
def test_encodes_like_the_library(codec, library, text):
    assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("alphabet", ["a", "ab", "the", "etaoinshrdlu", "!?.", "aA1.-", "éß日本", "lol'"])
def test_long_units_are_joined_exactly(codec, library, alphabet):
    source = random.Random(alphabet)
    for length in (bpe.PIECE - 1, bpe.PIECE + 1, 3 * bpe.PIECE + 5, 9001):
        text = "".join(source.choice(alphabet) for _ in range(length))
        text = text[:700] + "<|endoftext|>" + text[700:]
        assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_table_with_all_kinds_of_rows(make_docs, vocabulary, library):
    long = "Word " * 5000 + "x" * 9000 + " tail"
    pairs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "null id"), (4, long), (5, "y" * 70000)]
    docs = make_docs(pairs).withColumn("ids", F.lit("clash"))
    out = bpe.decode(bpe.encode(docs, vocabulary, long=2000), vocabulary)
    assert set(docs.columns) | {"decoded"} == set(out.columns)
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in out.collect()), key=str)
    want = []
    for i, text in pairs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)


def test_empty_table(make_docs, vocabulary):
    docs = make_docs([]).limit(0)
    assert bpe.encode(docs, vocabulary).count() == 0
    assert packing.pack(packing.cut_tokens(docs, vocabulary)).count() == 0


def test_pieces_and_places(make_docs, vocabulary, library):
    pairs = [(1, None), (2, "one two three"), (2, "one two three"), (3, "word " * 700), (4, "many " * 20000)]
    got = packing.pack(packing.cut_tokens(make_docs(pairs), vocabulary, capacity=512, with_ids=True), capacity=512)
    rows = got.collect()
    pieces = {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.piece), []).append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert len(pieces[2, 0]) == 2
    for i, text in pairs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 512)):
            assert pieces[i, k][0].start == at and pieces[i, k][0].ids == ids[at : at + 512]
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512


@pytest.mark.parametrize("seed", range(6))
def test_group_packing_is_valid_and_tight(seed):
    source = np.random.default_rng(seed)
    lengths = source.integers(1, [50, 200, 1000, 100, 101, 60][seed], 3000)
    sequences, offsets = packing.pack_group(lengths, 100 if seed in (0, 3, 5) else 1000)
    capacity = 100 if seed in (0, 3, 5) else 1000
    fill = np.bincount(sequences, weights=lengths)
    assert fill.max() <= capacity and (fill > 0).all()
    assert (np.sort(sequences * 10**6 + offsets) == sequences[np.lexsort((offsets, sequences))] * 10**6 + offsets[np.lexsort((offsets, sequences))]).all()
    best_fit = len(packing._best_fit(lengths.tolist(), capacity))
    assert len(fill) <= best_fit


def test_exchange_grows_the_squares():
    lengths = [60, 30, 55, 40, 45, 25, 20]
    bins = [[0, 1], [2, 6], [3, 5], [4]]
    before = sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    assert packing._exchange(bins, lengths, 100)
    assert sum(sum(lengths[i] for i in b) ** 2 for b in bins) > before
    assert sorted(i for b in bins for i in b) == list(range(7))


def test_several_rounds(spark):
    pieces = spark.range(6000).select(F.col("id"), (F.pmod(F.xxhash64("id"), F.lit(700)) + 1).alias("length"))
    got = packing.pack(pieces, capacity=1024, group=500).toPandas()
    assert len(got) == 6000 and got.groupby("sequence_id")["length"].sum().max() <= 1024
    assert got["sequence_id"].nunique() <= 1.02 * got["length"].sum() / 1024


def test_lengths_that_fill_no_sequence_are_dealt_until_nothing_is_left_to_gain(spark):
    pieces = spark.range(12000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 1100).otherwise(700).alias("length"))
    got = packing.pack(pieces, capacity=2048, group=1000).toPandas()
    assert len(got) == 12000 and got.groupby("sequence_id")["length"].sum().max() <= 2048
    assert got["sequence_id"].nunique() == 6000


def test_digest_query_matches_the_library(spark, library):
    from perennia.llm.catalog import QUERIES, table

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op10_bpe"](spark, folder).collect()}
    for r in table(spark, folder, "documents").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_packing_query_matches_the_library(spark, library):
    """Every piece of every document, cut and hashed by the library's ids; sequences without gaps, as few as can be."""
    from perennia.llm.catalog import QUERIES, table

    folder = "/root/testdata/sf0.001"
    want = []
    for r in table(spark, folder, "documents").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((r.doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = QUERIES["op6_best_fit_packing"](spark, folder).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences: dict[int, list[tuple[int, int]]] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= 2048
    least = -(-sum(w[3] for w in want) // 2048)
    assert least <= len(sequences) <= least + 1
