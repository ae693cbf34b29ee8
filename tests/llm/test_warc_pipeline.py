"""Archives as an exact round trip; the pipeline against plain code on its own stages."""

from __future__ import annotations

import hashlib
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from perennia.llm import warc

import corpus_pipeline


class Bytes:
    """What a file offers to the reader, and how much of it was read."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, length, offset):
        self.read += length
        return self.data[offset : offset + length]


@pytest.mark.parametrize("wide", [False, True])
def test_members_are_where_zipfile_wrote_them(wide):
    data = warc.package([b"abc" * 100, b"def"], [{"a": 1}], zip64=wide)
    found = warc.members(Bytes(data))
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        for name in archive.namelist():
            m = found[name]
            assert m.stored and data[m.start : m.start + m.length] == archive.read(name)


def test_zip64_end_record_and_comment():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for k in range(66000):
            archive.writestr(f"m{k}", b"x")
        archive.comment = b"a comment with PK\x05\x06 in it"
    found = warc.members(Bytes(out.getvalue()))
    assert len(found) == 66000 and found["m65999"].length == 1


def test_deflated_members_are_told_apart():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a", b"x" * 1000)
    assert not warc.members(Bytes(out.getvalue()))["a"].stored


@pytest.mark.parametrize("data", [b"", b"PK", b"no archive" * 100])
def test_not_an_archive(data):
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.members(Bytes(data))


ROWS = [
    (1, "http://a/1", "<p>one</p>", "x"), (2, "http://a/2", "<p>one</p>", "x"), (7, "http://a/7", "<p>one</p>", "x"),
    (3, None, None, "x"), (4, "http://a/ü ö\n4", "", "x"), (5, "u", "é\r\n\r\nWARC/1.1\r\n", "x"), (6, "u", "long " * 300000, "x"),
    (8, "u", "unique", "x"), (8, "u", "unique", "x"), (None, "u", "unique", "x"), (None, "u", "only here", "x"),
]


@pytest.mark.parametrize(("least", "size", "wide"), [(0, 1 << 24, False), (0, 1, True), (3, 200, False)])
def test_round_trip(spark, tmp_path, least, size, wide):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, digest string")
    packages = warc.write(warc.with_revisits(pages, least=least), f"file://{tmp_path}", size=size, zip64=wide)
    got = warc.read(warc.located(packages)).collect()
    assert len(got) == len(ROWS)
    bodies = {}
    for page, _, html, _ in ROWS:
        bodies.setdefault((html or "").encode(), []).append(page)
    seen = []
    for r in got:
        if r.record_type == "response":
            assert warc.digest_text(r.payload) == r.payload_digest and len(r.payload) == r.payload_bytes
        else:
            assert r.payload is None
        seen.append((r.page_id, r.payload_bytes, r.payload_digest, r.refers_to))
    want = []
    for body, pages_ in bodies.items():
        ids = [p for p in pages_ if p is not None]
        for page in pages_:
            refers = max(ids) if ids and page != max(ids) and len(body) >= least and len(pages_) > 1 else None
            want.append((page, len(body), warc.digest_text(body), refers))
    assert sorted(seen, key=str) == sorted(want, key=str)
    texts = {r.page_id: r.payload for r in got if r.record_type == "response"}
    assert texts[6] == ("long " * 300000).encode() and texts[5] == "é\r\n\r\nWARC/1.1\r\n".encode()


def test_reading_is_dealt_over_tasks(spark, tmp_path):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 20).alias("html"))
    packages = warc.write(warc.with_revisits(pages), str(tmp_path / "many"), size=1 << 16)
    ranges = warc.located(packages, range_bytes=1 << 12)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ranges.count() >= tasks
    records = warc.read(ranges).select("page_id", F.spark_partition_id().alias("task")).collect()
    assert len(records) == 400 and len({r.task for r in records}) == tasks


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    packages = warc.write(warc.with_revisits(pages), f"file://{tmp_path}/none")
    assert packages.count() == 0 and warc.read(warc.located(packages)).count() == 0


def test_damage_is_noticed(spark, tmp_path):
    data = warc.package([warc.record(1, "u", b"abc", "WRONG", None, "d", False)], [{"offset": 0, "length": len(warc.record(1, "u", b"abc", "WRONG", None, "d", False))}])
    (tmp_path / "a.wacz").write_bytes(data)
    packages = spark.createDataFrame([(f"file://{tmp_path}/a.wacz",)], "package string")
    with pytest.raises(Exception, match="damaged"):
        warc.read(warc.located(packages)).collect()


# -- pipeline

WORDS = "the of and house tree river walks under some light with green stone water morning never always people".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small folder of tables with planted cases."""
    source = random.Random(8)
    rows, labels = [], []
    for k in range(80):
        text = " ".join(source.choice(WORDS) + source.choice("abcdefgh") for _ in range(60))
        toxic = k % 8 == 0
        rows.append((k, text + (" you idiot stupid scum" if toxic else ""), "en", "s"))
        labels.append((k, 1, int(toxic)))
    rows.append((200, rows[1][1], "en", "s"))  # an exact and a near copy, and a repeated row
    rows.append((201, rows[2][1] + " end", "en", "s"))
    rows.append(rows[3])
    rows += [(300, None, "en", "s"), (301, "", "en", "s"), (302, "123 456 !!", "en", "s"), (None, "a text that has no id at all", "en", "s")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(*r, len(r[1] or ""), "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, language string")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder))
        assert docs.columns == columns, name
        kept.append(sorted(r.doc_id if r.doc_id is not None else -1 for r in docs.collect()))
    everyone = sorted([*range(80), 200, 201, 3, -1])
    assert kept[0] == everyone  # texts without letters went
    assert kept[1] == [k for k in everyone if k % 8 or k in (200,) or k > 80]
    assert kept[2] == sorted(set(kept[1]) - {200, 201})
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sorted({r.doc_id if r.doc_id is not None else -1 for r in packed}) == kept[2]
    fill = {}
    for r in packed:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048 and len(fill) <= sum(fill.values()) // 2048 + 2


def test_pipeline_of_nothing(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_sha1_is_the_library_one():
    assert warc.digest_text(b"") == __import__("base64").b32encode(hashlib.sha1(b"").digest()).decode()
