"""Near-duplicate vectors by spherical-cap filters.

The filters are random directions with structure: after a random rotation a vector is cut into ``PARTS`` parts, each part
has a small codebook of unit vectors, and a direction is a choice of one word for each part.  All directions whose product
with a vector exceeds a threshold are listed by decoding: words are combined part by part, and a beginning is given up
as soon as the best words of the remaining parts cannot lift it over the threshold.  Vectors that share a direction meet;
each pair is compared where it meets first, in double precision.

Equal vectors are one class.  A direction with many classes is split into cells of bounded size.  A cell returns counts and
the links of a spanning forest, so nothing grows with the number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import batch
from perennia.llm.components import components, forest
from perennia.llm.vectors import in_blocks, matrix, usable
from perennia.sources.scratch import stored

#: Parts of a vector and words of a part's codebook.
PARTS, WORDS = 2, 128
#: The threshold is this many times the usual size of a product with a random direction.
THRESHOLD = 2.9
#: Directions that every vector has at least: the best, where fewer exceed the threshold.
LEAST = 10
#: Classes of a block; two blocks meet in a cell.
BLOCK = 512


@cache
def codes(dim: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rotation and codebooks for vectors of a length; the same in every process."""
    random = np.random.default_rng(dim + 5)
    rotation = np.linalg.qr(random.normal(size=(dim, dim)))[0]
    books = []
    for part in np.array_split(np.arange(dim), min(PARTS, dim)):
        words = random.normal(size=(WORDS, len(part)))
        books.append(words / np.linalg.norm(words, axis=1, keepdims=True))
    return rotation, books


def decode(vectors: np.ndarray) -> list[np.ndarray]:
    """Sorted numbers of the directions near each vector (rows are of length 1)."""
    dim = vectors.shape[1]
    rotation, books = codes(dim)
    turned = vectors @ rotation
    threshold = THRESHOLD / np.sqrt(dim) * np.sqrt(len(books))
    scores, at = [], 0
    for book in books:
        scores.append(turned[:, at : at + book.shape[1]] @ book.T)
        at += book.shape[1]
    return [_directions([s[k] for s in scores], threshold) for k in range(len(vectors))]


def _directions(scores: list[np.ndarray], threshold: float) -> np.ndarray:
    rest = np.cumsum([s.max() for s in scores[::-1]])[::-1].tolist() + [0.0]  # best that the remaining parts can add
    limit = threshold
    while True:
        totals, numbers = np.zeros(1), np.zeros(1, np.int64)
        for part, words in enumerate(scores):
            sums = totals[:, None] + words[None, :]
            row, word = np.nonzero(sums >= limit - rest[part + 1])
            totals, numbers = sums[row, word], numbers[row] * WORDS + word
        if len(numbers) >= min(LEAST, WORDS ** len(scores)):
            break
        limit -= 0.1 * abs(threshold)
    if limit < threshold:
        numbers = numbers[np.argsort(-totals, kind="stable")[:LEAST]]
    return np.sort(numbers)


def _listed(classes: DataFrame) -> DataFrame:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists: list[np.ndarray] = [np.empty(0, np.int64)] * len(b)
            dims = b["dim"].to_numpy()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                x = matrix(b["vector"].take(pa.array(own)))
                x /= np.abs(x).max(axis=1, keepdims=True)
                for k, found in zip(own, decode(x / np.linalg.norm(x, axis=1, keepdims=True)), strict=True):
                    lists[k] = found
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lists, pa.list_(pa.int64()))], [*b.schema.names, "filters"])

    schema = "rep long, label string, vector array<double>, copies long, dim int, many boolean, filters array<long>"
    return classes.mapInArrow(listed, schema)


def links_in_cell(vectors: np.ndarray, own: np.ndarray, apart: bool, earlier: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of a cell are linked and meet first here; ``earlier``: which earlier directions each vector has."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    cosine = unit @ unit.T
    linked = cosine >= least
    for i, j in zip(*np.nonzero(np.abs(cosine - least) < 1e-12), strict=True):
        a, b = vectors[i], vectors[j]  # a matter of rounding: the plain formula decides
        linked[i, j] = sum((a * b).tolist()) / np.sqrt(sum((a * a).tolist()) * sum((b * b).tolist())) >= least
    met = (earlier @ earlier.T) > 0 if earlier.shape[1] else np.zeros_like(linked)
    linked &= ~met & ~np.eye(len(unit), dtype=bool)
    return linked & (own[:, None] != own[None, :]) if apart else linked


def _compared(members: DataFrame, least: float) -> DataFrame:
    """For each cell: (rep, links, other), links counted in copies; other is a linked class.

    Links of which a side has ``many`` come as rows of their own as well, without a number.
    """

    def one(rows: pa.Table) -> pa.RecordBatch | None:
        direction, apart = rows["filter"][0].as_py(), rows["apart"][0].as_py()
        reps, own, copies = (rows[c].to_numpy() for c in ("rep", "own", "copies"))
        lists = rows["filters"].to_pylist()
        before = sorted({f for x in lists for f in x if f < direction})
        place = {f: k for k, f in enumerate(before)}
        earlier = np.zeros((len(lists), len(before)), np.float32)
        for k, x in enumerate(lists):
            earlier[k, [place[f] for f in x if f < direction]] = 1
        linked = links_in_cell(matrix(rows["vector"]), own, apart, earlier, least)
        some = np.flatnonzero(linked.any(axis=1))
        if not len(some):
            return None
        order = np.argsort(reps, kind="stable")  # the least place is the least class
        roots = reps[order][forest(linked[np.ix_(order, order)])]
        other = np.empty_like(roots)
        other[order] = roots
        many = rows["many"].to_numpy(zero_copy_only=False).astype(bool)
        a, b = np.nonzero(linked & (many[:, None] | many[None, :])) if many.any() else (some[:0], some[:0])
        links = pa.array([*(linked @ copies)[some].astype(int).tolist(), *[None] * len(a)], pa.int64())
        return batch({
            "rep": pa.array(np.concatenate([reps[some], reps[a]])), "links": links, "other": pa.array(np.concatenate([other[some], reps[b]])),
        })

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for b in batches:
            kept = pa.concat_tables([kept, pa.Table.from_batches([b])]) if kept else pa.Table.from_batches([b])
            kept = yield from cells(kept, False)
        if kept:
            yield from cells(kept, True)

    def cells(rows: pa.Table, all_: bool) -> Iterator[pa.RecordBatch]:
        """Whole cells are compared; the last one waits for more rows."""
        cell = rows["cell"].to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)])) if len(cell) else np.array([0])
        last = len(starts) - 1 if all_ else len(starts) - 2
        for k in range(last):
            found = one(rows.slice(starts[k], starts[k + 1] - starts[k]))
            if found:
                yield found
        return rows.slice(starts[max(last, 0)]).combine_chunks()

    dealt = members.repartition("cell").sortWithinPartitions("cell", "rep")
    return dealt.mapInArrow(compared, "rep long, links long, other long")


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``.

    Two vectors of equal label are linked if their cosine is at least ``least``; n_links counts the other ids linked
    directly, component_id is the least id reachable.  Vectors that are null, empty, zero or hold null or non-finite components, and
    those without a label, are linked with nothing; a row without an id has a null component and is kept.  Repeated rows stay and
    are one vector; an id with different vectors is linked with what any of them is linked with.  Vectors of different length are
    never linked.
    """
    rows = vectors.select(F.col(id).cast("long").alias("vec"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label"))
    rows = rows.withColumn("fit", usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec").isNotNull())
    there = rows.filter("fit").groupBy("label", "vector", "vec").agg(F.count("*").alias("n"))
    often = there.groupBy("vec").agg(F.count("*").alias("n")).filter("n > 1").select("vec", F.lit(True).alias("several"))
    often = stored(often)  # ids with different vectors
    there = there.join(often, "vec", "left")
    # copies are the ids of this vector only
    classes = there.groupBy("label", "vector").agg(
        F.min("vec").alias("least"), F.count_if(F.col("several").isNull()).alias("copies"), (F.count("several") > 0).alias("many")
    )
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()))  # a number of its own for each vector
    listed = stored(_listed(classes.select("rep", "label", "vector", "copies", F.size("vector").alias("dim"), "many")))
    where = listed.select("rep", "label", "dim", F.explode("filters").alias("filter"))
    shared = where.groupBy("label", "dim", "filter").agg(F.count("*").alias("m")).filter("m > 1")
    members = where.join(shared, ["label", "dim", "filter"])
    members = in_blocks(members, F.ceil(F.col("m") / BLOCK).cast("int"), "rep")
    cell = F.xxhash64("label", "dim", "filter", F.least("own", "other"), F.greatest("own", "other"))
    members = members.select("rep", "label", "filter", "own", (F.col("own") != F.col("other")).alias("apart"), cell.alias("cell"))
    members = members.join(listed.select("rep", "vector", "copies", "many", "filters"), "rep")
    found = stored(_compared(members, least))
    # classes of one id are connected, and ids with different vectors are counted by themselves
    held = stored(there.filter("several").join(classes.select("label", "vector", "rep"), ["label", "vector"]).select("vec", "rep"))
    one = held.groupBy("vec").agg(F.min("rep").alias("b")).join(held, "vec").select(F.col("rep").alias("a"), "b")
    roots = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")).unionByName(one))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    near = found.filter("links is null").select("rep", "other").unionByName(held.select("rep", F.col("rep").alias("other"))).distinct()
    with_id = held.select(F.col("rep").alias("other"), F.col("vec").alias("id"))
    others = near.join(with_id, "other").select("rep", "id").distinct().groupBy("rep").agg(F.count("*").alias("others"))
    of_id = near.join(held, "rep").select("vec", "other").distinct()
    alone = of_id.join(classes.select(F.col("rep").alias("other"), "copies"), "other").groupBy("vec").agg(F.sum("copies").alias("alone"))
    beside = of_id.join(with_id, "other").select("vec", "id").distinct().groupBy("vec").agg(F.count("*").alias("beside"))
    of_id = alone.join(beside, "vec").select("vec", (F.col("alone") + F.col("beside") - 1).alias("n_id"), F.lit(True).alias("fit"))

    placed = classes.join(counts, "rep", "left").join(others, "rep", "left").join(roots.toDF("rep", "number"), "rep", "left")
    placed = placed.withColumn("number", F.coalesce("number", "rep"))
    root = placed.groupBy("number").agg(F.min("least").alias("root"))
    number = F.coalesce("links", F.lit(0)) + F.col("copies") + F.coalesce("others", F.lit(0)) - 1
    placed = placed.join(root, "number").select("label", "vector", number.alias("n"), "root", F.lit(True).alias("fit"))
    out = rows.join(placed, ["fit", "label", "vector"], "left").join(of_id, ["fit", "vec"], "left").withColumn("n", F.coalesce("n_id", "n"))
    component = F.coalesce("root", "vec")
    return out.select(
        F.col("vec").alias("vec_id"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec") == component, F.lit(True)).alias("kept"),
    )
