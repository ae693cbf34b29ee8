"""Near-duplicate documents by MinHash with tensored banding.

A document's shingles give ``2 * SIDE`` half keys of ``ROWS`` minhashes each.  Instead of hashing ``SIDE ** 2`` tables
apart, each table takes one half key of the first collection and one of the second, so 96 minhashes make 256 tables of six.
Two sets of similarity 0.8 meet in no table with a probability of 2e-5, of 0.85 with 5e-7.

Documents with equal sets are one class.  Classes that share half keys of both collections with another are spread over the
tables.  In each table's bucket the least class is the centre: every class is first compared with the most similar of its
centres, on full sets.  Classes of buckets that then still hold several components are compared whole, in cells of
bounded size: products of 0-1 matrices give the sizes of all intersections of full sets.  A cell returns no more links
than join its components, so nothing that is shuffled grows with the number of pairs, and no link that joins components is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import batch, begin
from perennia.llm.components import components, forest
from perennia.llm.vectors import in_blocks
from perennia.sources.scratch import stored

#: Minhashes of a half key, half keys of each collection.
ROWS, SIDE = 3, 16
HASHES = 2 * SIDE * ROWS
#: Sketches of similar sets agree in at least this many of ``HASHES`` bytes (0.8: fewer with probability 1e-8).
AGREEING = 54
#: Classes of a block, and copies that are compared with one centre at a time.
CELL = 512
#: Shingles of a block.
SHINGLES = 1 << 19
#: Bits of the filter that tells which texts a comparison does not need.
FILTER_BITS = 1 << 24

_random = np.random.default_rng(20)
_XOR = _random.integers(0, 1 << 64, HASHES, np.uint64, endpoint=False)
_ODD = _random.integers(0, 1 << 64, HASHES, np.uint64, endpoint=False) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words; of fewer words, one of all.

    Words are runs without ASCII white space; A-Z are lower-cased.
    """
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    whole = np.full(n, width, np.uint64)
    for k in range(width):
        whole = whole * _STEP + hashes[k : k + n]
    return np.unique(_mixed(whole))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        some = (shingles[at : at + 2048, None] ^ _XOR) * _ODD
        np.minimum(best, (some ^ (some >> np.uint64(32))).min(axis=0), out=best)
    return best


def half_keys(least: np.ndarray) -> np.ndarray:
    """``2 * SIDE`` keys; the place is part of a key, so keys of different places never meet."""
    keys = (np.arange(2 * SIDE, dtype=np.uint64) + np.uint64(1)) * _STEP
    for k in range(ROWS):
        keys = _mixed(keys ^ least.reshape(-1, ROWS)[:, k])
    return keys.view(np.int64)


def _print(shingles: np.ndarray) -> list[int]:
    """The fingerprint of a set, as two signed numbers."""
    import xxhash

    return np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), "<i8").tolist()


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc, n (size of the set), two halves of the set's fingerprint, half keys and sketch; nulls for empty sets."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("minhash")
        for b in batches:
            sizes, prints, keys, sketches = [], [], [], []
            for text in b[1].to_pylist():
                shingles = shingle_set(text, width)
                sizes.append(len(shingles))
                if not len(shingles):
                    prints.append((None, None))
                    keys.append(None)
                    sketches.append(None)
                    continue
                least = minhashes(shingles)
                prints.append(_print(shingles))
                keys.append(half_keys(least))
                sketches.append(_mixed(least).astype(np.uint8).tobytes())
            columns = {"doc": b[0], "n": pa.array(sizes, pa.int64())}
            columns |= {f"f{k}": pa.array([p[k] for p in prints], pa.int64()) for k in (0, 1)}
            yield batch(columns | {"keys": pa.array(keys, pa.list_(pa.int64())), "sketch": pa.array(sketches, pa.binary())})

    return docs.mapInArrow(made, "doc long, n long, f0 long, f1 long, keys array<long>, sketch binary")


def _tables(classes: DataFrame) -> DataFrame:
    """(bucket, rep) for the classes that share half keys of both collections with others."""
    halves = classes.select("rep", F.posexplode("keys").alias("place", "key"))
    shared = halves.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    met = halves.join(shared, "key").groupBy("rep").agg(F.collect_list(F.struct("place", "key")).alias("met"))
    first = F.filter("met", lambda x: x["place"] < SIDE)
    second = F.filter("met", lambda x: x["place"] >= SIDE)
    spread = met.select("rep", F.explode(first).alias("x"), second.alias("second")).select("rep", "x", F.explode("second").alias("y"))
    return spread.select(F.xxhash64("x.key", "y.key").alias("bucket"), "rep")


def _agreeing(a: pa.Array, b: pa.Array) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(-1, HASHES) for s in (a, b))
    return (x == y).sum(axis=1)


def agreement(a: Column, b: Column) -> Column:
    @F.arrow_udf("int")
    def counted(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(_agreeing(x, y) if len(x) else [], pa.int32())

    return counted.asNondeterministic()(a, b)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _star_pairs(tables: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each class and the most similar of the centres of its buckets, if it may link."""
    centres = tables.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count("*").alias("m")).filter("m > 1")
    pairs = tables.join(centres.drop("m"), "bucket").filter("rep <> centre").select("rep", "centre").distinct()
    about = classes.select("rep", "n", "sketch")
    pairs = pairs.join(about, "rep").join(about.toDF("centre", "cn", "csketch"), "centre").filter(_may_link("n", "cn", percent))
    pairs = pairs.select("rep", "centre", agreement(F.col("sketch"), F.col("csketch")).alias("agree")).filter(F.col("agree") >= AGREEING)
    return pairs.groupBy("rep").agg(F.max_by("centre", F.struct("agree", -F.col("centre"))).alias("centre")).select(F.col("rep").alias("a"), F.col("centre").alias("b"))


def _open_cells(tables: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """(doc, root, cell, own, apart): where the classes meet whose buckets hold several components.

    Components that meet in a bucket are one cluster.  A cluster is dealt into blocks of bounded size, and every two
    blocks meet in one cell, so each class is sent a few times however many buckets it is in.
    """
    placed = tables.join(roots.toDF("rep", "root"), "rep", "left").select("bucket", "rep", F.coalesce("root", "rep").alias("root"))
    placed = stored(placed)
    several = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    there = placed.join(several, "bucket")
    members = stored(there.groupBy("rep").agg(F.first("root").alias("root")))
    clusters = components(there.select(F.col("root").alias("a"), F.col("x").alias("b")).distinct()).toDF("root", "cluster")
    members = members.join(clusters, "root").join(classes.select("rep", "n"), "rep")
    sizes = members.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / CELL, F.sum("n") / SHINGLES)).cast("int").alias("blocks")
    )
    dealt = in_blocks(members.join(sizes, "cluster"), F.col("blocks"), "rep")
    cell = F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other")).alias("cell")
    return dealt.select(F.col("rep").alias("doc"), "root", cell, "own", (F.col("own") != F.col("other")).alias("apart"))


def _texts_of(docs: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """``wanted`` (doc, the number of a class, and more) with the texts of the class's least id and its fingerprint.

    An id may have other texts too: those whose set has another fingerprint are passed over by ``_own_set``.
    The join is a shuffle at every size, so that a task never holds the worker of ``_needed`` and that of the sets.
    """
    wanted = stored(wanted.join(classes.select(F.col("rep").alias("doc"), "least", "f0", "f1"), "doc"))
    texts = docs.select(F.col("doc").alias("least"), "text")
    return _needed(texts, wanted.select("least"), "least").join(wanted.hint("merge"), "least").drop("least")


def _own_set(text: str | None, width: int, f0: int, f1: int) -> bytes | None:
    shingles = shingle_set(text, width)
    return shingles.tobytes() if _print(shingles) == [f0, f1] else None


def _open_links(docs: DataFrame, cells: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between components, found on the full sets of each cell; as many as join what is linked there."""
    wanted = cells.groupBy("doc").agg(F.first("root").alias("root"), F.collect_list(F.struct("cell", "own", "apart")).alias("to"))
    texts = _texts_of(docs, wanted, classes)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text, root, to, *f in zip(*(b[c].to_pylist() for c in ("doc", "text", "root", "to", "f0", "f1")), strict=True):
                packed = _own_set(text, width, *f)
                if packed is None:
                    continue
                columns = {c: pa.array([t[c] for t in to], k) for c, k in (("cell", pa.int64()), ("own", pa.int32()), ("apart", pa.bool_()))}
                columns |= {c: pa.array([v] * len(to), pa.int64()) for c, v in (("doc", doc), ("root", root))}
                yield batch(columns | {"shingles": pa.array([packed] * len(to), pa.binary())})

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("minhash")
        kept: pa.Table | None = None
        for b in batches:
            kept = pa.concat_tables([kept, pa.Table.from_batches([b])]) if kept else pa.Table.from_batches([b])
            kept = yield from whole_cells(kept, False)
        if kept:
            yield from whole_cells(kept, True)

    def whole_cells(rows: pa.Table, all_: bool) -> Iterator[pa.RecordBatch]:
        """Cells are compared; the last one waits for more rows."""
        cell = rows["cell"].to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)])) if len(cell) else np.array([0])
        last = len(starts) - 1 if all_ else len(starts) - 2
        for k in range(last):
            yield _links_of_cell(rows.slice(starts[k], starts[k + 1] - starts[k]), percent)
        return rows.slice(starts[max(last, 0)]).combine_chunks()

    spread = texts.select("doc", "text", "root", "to", "f0", "f1").mapInArrow(
        sets, "cell long, own int, apart boolean, doc long, root long, shingles binary"
    )
    dealt = spread.repartition("cell").sortWithinPartitions("cell", "doc")
    return stored(dealt.mapInArrow(compared, "a long, b long"))


def _links_of_cell(rows: pa.Table, percent: int) -> pa.RecordBatch:
    docs, roots, own = (rows[c].to_numpy() for c in ("doc", "root", "own"))
    found: dict[int, tuple[int, np.ndarray]] = {}
    for k, packed in enumerate(rows["shingles"].to_pylist()):
        shingles = np.frombuffer(packed, np.uint64)
        found.setdefault(docs[k], (k, shingles))  # rows of one text are one
    some = np.array([k for k, _ in found.values()], np.int64)
    docs, roots, own = docs[some], roots[some], own[some]
    none = batch({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    apart = roots[:, None] != roots[None, :]
    if rows["apart"][0].as_py():
        apart &= own[:, None] != own[None, :]
    if not apart.any():
        return none
    sizes = np.array([len(s) for _, s in found.values()])
    both = _shared([s for _, s in found.values()])
    linked = apart & (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both))
    order = np.argsort(docs, kind="stable")
    least = docs[order][forest(linked[np.ix_(order, order)])]
    joined = least != docs[order]
    return batch({"a": pa.array(docs[order][joined]), "b": pa.array(least[joined])}) if joined.any() else none


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements every two sets share: products of 0-1 matrices, over the elements that several sets have."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    several = counts[column] > 1
    rows, column = rows[several], number[column[several]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total = np.zeros((len(sets), len(sets)))
    last = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, last, 2048):
        start, stop = np.searchsorted(column, [at, at + 2048])
        held = np.zeros((len(sets), 2048), np.float32)
        held[rows[start:stop], column[start:stop] - at] = 1
        total += held @ held.T
    return total.astype(np.int64)


def _needed(docs: DataFrame, ids: DataFrame, id: str) -> DataFrame:
    """``docs`` without most of the rows whose ``id`` is not in ``ids``: a filter of fixed size, right for any number."""
    place = F.pmod(F.xxhash64(id), F.lit(FILTER_BITS))
    words = ids.select(place.alias("p")).groupBy((F.col("p") / 32).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("bits")
    )
    found = words.toArrow()  # FILTER_BITS / 32 rows at most; as columns, since row objects take 30 times their memory
    bitmap = np.zeros(FILTER_BITS // 32, np.uint32)
    bitmap[found["w"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def maybe(places: pa.Array) -> pa.Array:
        p = places.to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array((shared.value[p >> 5] >> (p & 31).astype(np.uint32) & 1).astype(bool))

    return docs.filter(F.col(id).isNotNull()).filter(maybe(place))


def confirmed(docs: DataFrame, pairs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough; ``docs`` (doc, text) holds their texts."""
    pairs = stored(pairs.select("a", "b"))
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    sent = pairs.join(sizes, "b").select(
        F.col("a").alias("doc"), F.struct("b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")).alias("to")
    )
    own = sizes.select(F.col("b").alias("doc"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    own = own.select("doc", F.struct(F.col("doc").alias("b"), "part").alias("to"))
    texts = _texts_of(docs, sent.unionByName(own).groupBy("doc").agg(F.collect_list("to").alias("to")), classes)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text, to, *f in zip(*(b[c].to_pylist() for c in ("doc", "text", "to", "f0", "f1")), strict=True):
                packed = _own_set(text, width, *f)
                if packed is None:
                    continue
                yield batch(
                    {
                        "b": pa.array([t["b"] for t in to], pa.int64()),
                        "part": pa.array([t["part"] for t in to], pa.int32()),
                        "doc": pa.array([doc] * len(to), pa.int64()),
                        "shingles": pa.array([packed] * len(to), pa.binary()),
                    }
                )

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        centre = rows["b"].iloc[0]
        found: dict[int, np.ndarray] = {}
        for doc, packed in zip(rows["doc"], rows["shingles"], strict=True):
            shingles = np.frombuffer(packed, np.uint64)
            found.setdefault(doc, shingles)  # rows of one text are one
        own = found.pop(centre, np.empty(0, np.uint64))
        out = []
        for doc, other in found.items():
            both = int(np.isin(other, own, assume_unique=True).sum())
            if 100 * both >= percent * (len(own) + len(other) - both):
                out.append((doc, centre))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    spread = texts.select("doc", "text", "to", "f0", "f1").mapInArrow(sets, "b long, part int, doc long, shingles binary")
    return stored(spread.groupBy("b", "part").applyInPandas(linked, "a long, b long"))


def _of_one_id(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that the texts of one id belong to."""
    there = signed.filter("n > 0 and doc is not null").groupBy("doc", "f0", "f1").agg(F.count("*").alias("copies"))
    several = there.groupBy("doc").agg(F.count("*").alias("texts")).filter("texts > 1").select("doc")
    there = there.join(several, "doc").join(classes.select("f0", "f1", "rep"), ["f0", "f1"]).select("doc", "rep")
    first = there.groupBy("doc").agg(F.min("rep").alias("b"))
    return stored(there.join(first, "doc").filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct())


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Two documents are linked if the shingles they share are at least ``percent`` of a hundred of those that either
    has; component_id is the least id reachable over links.  A text without words is linked with nothing, and neither
    is a row without an id: its component_id is null and it is kept.  Repeated rows stay, in one component.  An id with
    different texts is linked with what is similar to any of them.  Other columns are not looked at.
    """
    docs = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    signed = stored(signatures(docs, width))
    equal = signed.filter("n > 0 and doc is not null").groupBy("f0", "f1").agg(
        F.min("doc").alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
    )
    classes = stored(equal.withColumn("rep", F.monotonically_increasing_id()))  # a number of its own for each set
    tables = stored(_tables(classes))
    links = confirmed(docs, _star_pairs(tables, classes, percent), classes, width, percent).unionByName(_of_one_id(signed, classes))
    roots = components(links)
    more = _open_links(docs, _open_cells(tables, classes, roots), classes, width, percent)
    roots = components(links.unionByName(more))
    placed = classes.join(roots.toDF("rep", "number"), "rep", "left").select("f0", "f1", "least", F.coalesce("number", "rep").alias("number"))
    least = placed.groupBy("number").agg(F.min("least").alias("root"))
    placed = placed.join(least, "number").select("f0", "f1", "root")
    found = signed.select("doc", "n", "f0", "f1").join(placed, ["f0", "f1"], "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("root", "doc"))
    return found.select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )
