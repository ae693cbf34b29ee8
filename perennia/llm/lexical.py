"""Ranked lexical search by a scan of all documents with one automaton.

The terms of all items go into an Aho-Corasick automaton, each between two blanks.  A text whose separators are made
blanks is read by it once, and every occurrence of every term is reported, whole words only; so a document's term
frequencies come from its text without an index of the documents.  How many documents hold each term is summed over
all documents; then each task adds up the scores of its documents, goes from terms to the items that have them, and
keeps the best of each item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perennia.llm.common import batch, begin, temporary
from perennia.sources.scratch import stored

#: Pairs of item and term of one automaton: more items are searched for in several scans.
PAIRS = 1_000_000
#: Characters of a term: digits, letters and everything beyond ASCII; A-Z count as a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Scores that are added up at once, and entries of an item before it is cut to the best.
AT_ONCE = 1 << 16
ENTRIES = 4

#: Bytes of a text in UTF-8: separators become blanks, A-Z become a-z.
_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def plain(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES)


class Automaton:
    """Counts the terms of a text."""

    def __init__(self, terms: list[str]):
        self.found = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            self.found.add_word(f" {plain(term).decode('latin-1')} ", number)
        self.found.make_automaton()

    def counts(self, text: str) -> tuple[int, Counter]:
        """Terms of any kind, with repeats, and how often each known one occurs."""
        own = plain(text)
        return len(own.split()), Counter(map(itemgetter(1), self.found.iter(f" {own.decode('latin-1')} ")))


_BUILT: dict[str, Automaton] = {}


def _automaton(name: str, terms) -> Automaton:
    """The automaton of a broadcast list of terms, built once in a worker; a worker keeps one."""
    begin("lexical", _BUILT.clear)
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton(terms.value)
    return _BUILT[name]


def terms_of(items: DataFrame, id: str, text: str) -> DataFrame:
    """item, term: each term of an item once."""
    words = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), SEPARATORS)
    return items.select(F.col(id).cast("long").alias("item"), F.explode(words).alias("term")).filter("term <> ''").distinct()


def _scan(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Of each document with terms: how many it has, and numbers and frequencies of those that items have."""
    shipped, name = docs.sparkSession.sparkContext.broadcast(terms), temporary("terms")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, shipped)
        for b in batches:
            ids, sizes, numbers, often = [], [], [], []
            for id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                n, counts = automaton.counts(text.as_py() or "")
                if n:
                    ids.append(id)
                    sizes.append(n)
                    numbers.append(np.fromiter(counts.keys(), np.int32, len(counts)))
                    often.append(np.fromiter(counts.values(), np.int64, len(counts)))
            starts = np.cumsum([0, *(len(x) for x in numbers)]).astype(np.int32)
            yield batch({
                "doc_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()),
                "terms": pa.ListArray.from_arrays(starts, np.concatenate(numbers) if numbers else np.zeros(0, np.int32)),
                "often": pa.ListArray.from_arrays(starts, np.concatenate(often) if often else np.zeros(0, np.int64)),
            })

    return docs.mapInArrow(scan, "doc_id long, n long, terms array<int>, often array<long>")


def _holders(counted: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for b in batches:
            total += np.bincount(b.column("terms").flatten().to_numpy(), minlength=terms)
        there = np.flatnonzero(total)
        yield batch({"term": pa.array(there, pa.int32()), "df": pa.array(total[there], pa.int64())})

    sums = counted.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(terms, np.int64)
    for row in sums.collect():  # at most PAIRS rows
        df[row["term"]] = row["df"]
    return df


class Best:
    """The k best documents of each item."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.zeros(items, np.int64)  # scores must reach it
        self.held: list[list[tuple]] = [[] for _ in range(items)]

    def add(self, scores: np.ndarray, ids: list) -> None:
        """``scores`` of documents (rows) and items (columns)."""
        for doc, item in zip(*(x.tolist() for x in np.nonzero((scores >= self.least) & (scores > 0))), strict=True):
            score, id = int(scores[doc, item]), ids[doc]
            if score >= self.least[item]:
                held = self.held[item]
                held.append((-score, id is None, id))
                if len(held) >= ENTRIES * self.k:
                    self.cut(item)

    def cut(self, item: int) -> None:
        held = self.held[item]
        held.sort(key=lambda e: (e[0], e[1], e[2] or 0))
        del held[self.k :]
        if len(held) == self.k:
            self.least[item] = -held[-1][0]

    def rows(self) -> pa.RecordBatch:
        for item in range(len(self.held)):
            self.cut(item)
        entries = [(item, e[2], -e[0]) for item, held in enumerate(self.held) for e in held]
        columns = list(zip(*entries, strict=True)) or [(), (), ()]
        return batch({n: pa.array(c, pa.int64()) for n, c in zip(("item", "doc_id", "score"), columns, strict=True)})


def _best(counted: DataFrame, weights: np.ndarray, of_term: tuple[np.ndarray, np.ndarray], items: int, docs: int, length: int, k: int) -> DataFrame:
    """item (its number), doc_id, score: the best documents of each item in each task."""
    shipped = counted.sparkSession.sparkContext.broadcast((weights, *of_term))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, starts, of = shipped.value
        best, step = Best(items, k), max(1, AT_ONCE // items)
        for b in batches:
            for at in range(0, len(b), step):
                part = b.slice(at, step)
                rows = len(part)
                # Python's whole numbers do not overflow
                m = np.array([50 + 50 * n * docs // length for n in part.column("n").to_pylist()], np.int64)
                sizes = pa.compute.list_value_length(part.column("terms")).to_numpy().astype(np.int64)
                terms = part.column("terms").flatten().to_numpy()
                tf = part.column("often").flatten().to_numpy()
                doc = np.repeat(np.arange(rows), sizes)
                value = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                many = starts[terms + 1] - starts[terms]  # items of each term
                ends = np.cumsum(many)
                place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many) + np.repeat(starts[terms], many)
                scores = np.zeros(rows * items, np.int64)
                np.add.at(scores, np.repeat(doc, many) * items + of[place], np.repeat(value, many))
                best.add(scores.reshape(rows, items), part.column("doc_id").to_pylist())
        yield best.rows()

    return counted.mapInArrow(score, "item long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of highest score above 0 for each item.

    Every row of ``docs`` is a document, rows of one id too; a null or empty text has no terms.  Equal scores go by
    ascending id, documents without an id last.  Rows of one item id (null is an id) are one item with the terms of all.
    Items without terms, and empty tables, give no rows.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    pairs = stored(terms_of(items, item_id, item_text))
    blocks = max(1, -(-pairs.count() // PAIRS))
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    results = []
    for block in range(blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()  # about PAIRS rows at most
        names = sorted({r["item"] for r in own}, key=lambda i: (i is None, i or 0))
        terms = sorted({r["term"] for r in own})
        if not terms:
            continue
        item_no, term_no = {i: k for k, i in enumerate(names)}, {t: k for k, t in enumerate(terms)}
        both = sorted((term_no[r["term"]], item_no[r["item"]]) for r in own)
        starts = np.searchsorted(np.array([t for t, _ in both]), np.arange(len(terms) + 1))
        of_term = starts.astype(np.int64), np.array([i for _, i in both], np.int64)
        counted = stored(_scan(docs, terms))
        totals = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
        if not totals["docs"]:
            continue
        ratio = ((2 * totals["docs"] + 2) / (2 * int(d) + 1) for d in _holders(counted, len(terms)))
        weights = np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)
        found = _best(counted, weights, of_term, len(names), totals["docs"], totals["length"], k)
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
        found = found.withColumn("rank", place).filter(F.col("rank") <= k)
        number = spark.createDataFrame(list(enumerate(names)), "item long, item_id long")
        results.append(found.join(F.broadcast(number), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for r in results[1:]:
        whole = whole.unionByName(r)
    return whole
