"""Exact top-k by inner product with vector-approximation files.

The approximation file holds one byte a component: the number of its cell among ``CELLS`` cells of that component,
equally filled on a sample.  Every query is compared with every approximation, in blocks: the cells' middles and half
widths bound the inner product from both sides, by two matrix products.  A row whose upper bound is below the k-th
lower bound of a query is done with.  Of the others, exact vectors are read in the order of their bounds: the first
``FIRST * k`` of a query, and then only those whose bound reaches the k-th score found.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perennia.llm.common import batch
from perennia.llm.vectors import matrix
from perennia.sources.scratch import stored

#: Cells of a component; their numbers fit a byte.
CELLS = 256
#: Rows on which the cells' edges are learned; the least and greatest values are those of all rows.
SAMPLE = 16_384
#: Queries and candidates of a block, and candidates of a tile.
QUERY_BLOCK, CANDIDATE_BLOCK, TILE = 1024, 16_384, 2048
#: Exact vectors of a query that are read first, as a multiple of k.
FIRST = 2
#: Scores are whole numbers of this range.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class Grid(NamedTuple):
    """Cells of vectors of one length: edges (length, CELLS + 1); cell j holds whole numbers from edge j to below edge j + 1."""

    edges: np.ndarray

    def numbers(self, vectors: np.ndarray) -> np.ndarray:
        inner = self.edges[:, 1:-1]
        out = np.empty(vectors.shape, np.uint8)
        for d in range(vectors.shape[1]):
            out[:, d] = np.searchsorted(inner[d], vectors[:, d], side="right")
        return out

    def bounds(self, queries: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner products of all pairs, as doubles that allow for their own rounding."""
        low, high = self.edges[:, :-1].astype(float), np.maximum(self.edges[:, 1:] - 1, self.edges[:, :-1]).astype(float)
        at = np.arange(len(low))
        middle, half = ((low + high) / 2)[at, cells], ((high - low) / 2)[at, cells]
        greatest = np.maximum(np.abs(low), np.abs(high)).max(axis=1)
        slack = (np.abs(queries) @ greatest)[:, None] * (4e-16 * (len(low) + 4))
        about, width = queries @ middle.T, np.abs(queries) @ half.T + slack
        return np.clip(about - width, LEAST, MOST), np.clip(about + width, LEAST, MOST)


def grid_of(sample: np.ndarray, low: np.ndarray, high: np.ndarray) -> Grid:
    """Equally filled cells between the least and the greatest value of each component."""
    inner = np.quantile(sample, np.arange(1, CELLS) / CELLS, axis=0, method="nearest").T if len(sample) else np.zeros((len(low), CELLS - 1))
    inner = np.clip(inner.astype(np.int64), low[:, None], high[:, None])
    top = np.minimum(high, MOST - 1) + 1
    return Grid(np.concatenate([low[:, None], inner, top[:, None]], axis=1))


def whole(column) -> np.ndarray:
    """Rows of equal length as whole numbers."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows, cut to the range of a long."""
    if not a.size:
        return np.zeros(len(a), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**62 and min(a.min(), b.min()) > LEAST:
        return np.einsum("ij,ij->i", a, b)
    sums = (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.array([min(MOST, max(LEAST, int(s))) for s in sums], np.int64)


def survivors(grid: Grid, queries: np.ndarray, query_ids: np.ndarray, cells: np.ndarray, ids: np.ndarray, leads: np.ndarray, k: int):
    """Pairs of a block that may be among the k best: rows of queries and candidates, lower and upper bounds.

    ``leads`` marks one row of each id, so that the k-th lower bound is one of k ids.
    """
    best = np.full((len(queries), k), -np.inf)
    found = []
    for at in range(0, len(ids), TILE):
        own = slice(at, at + TILE)
        low, high = grid.bounds(queries, cells[own])
        same = query_ids[:, None] == ids[own][None, :]
        sure = np.where(same | ~leads[own][None, :], -np.inf, low)
        best = np.concatenate([best, sure], axis=1)
        best = np.partition(best, best.shape[1] - k, axis=1)[:, -k:]
        row, col = np.nonzero((high >= best.min(axis=1)[:, None]) & ~same)
        found.append((row, col + at, low[row, col], high[row, col]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0)
    row, col, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = high >= best.min(axis=1)[row]
    return row[keep], col[keep], low[keep], high[keep]


def _grids(rows: DataFrame, n: int) -> dict[int, Grid]:
    """The cells of each length of vectors."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, np.ndarray] = {}
        most: dict[int, np.ndarray] = {}
        for b in batches:
            dims, vectors = b.column("dim").to_numpy(), b.column("vector")
            for dim in np.unique(dims).tolist():
                m = whole(vectors.filter(pa.array(dims == dim)))
                least[dim] = np.minimum(least.get(dim, MOST), m.min(axis=0))
                most[dim] = np.maximum(most.get(dim, LEAST), m.max(axis=0))
        for dim in least:
            yield batch({
                "dim": pa.array([dim] * dim, pa.int32()), "at": pa.array(range(dim), pa.int32()),
                "low": pa.array(least[dim], pa.int64()), "high": pa.array(most[dim], pa.int64()),
            })

    each = rows.select("dim", "vector").mapInArrow(ends, "dim int, at int, low long, high long")
    ranges: dict[int, list] = {}
    for r in each.groupBy("dim", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        ranges.setdefault(r["dim"], []).append((r["at"], r["low"], r["high"]))
    every = -(-n // SAMPLE) or 1
    taken = rows.filter(F.pmod(F.xxhash64("no"), F.lit(every)) == 0).limit(2 * SAMPLE).select("dim", "vector").toArrow()
    dims = taken["dim"].to_numpy()
    grids = {}
    for dim, parts in ranges.items():
        low, high = (np.array([p[k] for p in sorted(parts)], np.int64) for k in (1, 2))
        grids[dim] = grid_of(whole(taken["vector"].filter(pa.array(dims == dim))), low, high)
    return grids


def _numbered(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """The exact file: distinct rows with a number, and one row of each id marked; and how many rows and queries."""
    sizes = vectors.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n").alias("most")).first()
    if (sizes["most"] or 0) > 1:
        distinct = stored(vectors.groupBy("id", "vector", "dim").agg(F.max("is_query").alias("is_query")))
        first = distinct.groupBy("id").agg(F.min("vector").alias("first"))
        marked = distinct.join(first, "id").withColumn("lead", F.col("vector") == F.col("first")).drop("first")
    else:
        marked = vectors.withColumn("lead", F.lit(True))
    rows = stored(marked.withColumn("no", F.monotonically_increasing_id()))
    counts = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    return rows, counts["n"], counts["q"]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k rows of greatest inner product for each row where ``is_query`` holds.

    Components are floor(scale * x) of x as double.  Greatest first, ties to the smaller id; fewer rows if there are
    fewer candidates.  Rows without an id, and vectors that are null or hold null or non-finite components, take no
    part; empty and zero vectors do.  Vectors of other lengths than the query's are no candidates.  Rows of one id are one
    candidate, and one query, at the greatest of their scores.  Whole numbers and scores are cut to the range of a long.
    """
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.filter(F.col(id).isNotNull() & F.coalesce(~bad, F.lit(False)) & F.col(vector).isNotNull())
    rows = rows.select(
        F.col(id).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("vector"),
        F.size(vector).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows, n, asked = _numbered(rows)
    grids = vectors.sparkSession.sparkContext.broadcast(_grids(rows, n))  # CELLS + 1 numbers a component

    def approximated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = b.filter(pa.array(dims == dim))
                cells = grids.value[dim].numbers(whole(own.column("vector"))) if dim else np.zeros((len(own), 0), np.uint8)
                yield batch({
                    "no": own.column("no"), "id": own.column("id"), "dim": own.column("dim"), "lead": own.column("lead"),
                    "cells": pa.array([c.tobytes() for c in cells], pa.binary()),
                })

    groups, blocks = -(-n // CANDIDATE_BLOCK) or 1, -(-asked // QUERY_BLOCK) or 1
    number = F.xxhash64("no")
    all_groups, all_blocks = (F.explode(F.sequence(F.lit(0), F.lit(m - 1))) for m in (groups, blocks))
    queries = rows.filter("is_query").select(
        "no", "id", "dim", "lead", F.lit(None).cast("binary").alias("cells"), "vector",
        F.pmod(number, F.lit(blocks)).cast("int").alias("block"), all_groups.alias("group"),
    )
    cells = rows.select("no", "id", "dim", "lead", "vector").mapInArrow(approximated, "no long, id long, dim int, lead boolean, cells binary")
    there = cells.select(
        "no", "id", "dim", "lead", "cells", F.lit(None).cast("array<long>").alias("vector"),
        all_blocks.alias("block"), F.pmod(number, F.lit(groups)).cast("int").alias("group"),
    )

    def scan(table: pa.Table) -> pa.Table:
        asks = table["vector"].is_valid()
        q, c = table.filter(asks), table.filter(pa.compute.invert(asks))
        dim = table["dim"][0].as_py()
        grid = grids.value.get(dim) or Grid(np.zeros((0, CELLS + 1), np.int64))
        packed = np.frombuffer(b"".join(c["cells"].to_pylist()), np.uint8).reshape(len(c), dim)
        wanted = whole(q["vector"]).reshape(len(q), dim).astype(float)
        ids, leads = c["id"].to_numpy(), c["lead"].to_numpy(zero_copy_only=False).astype(bool)
        row, col, low, high = survivors(grid, wanted, q["id"].to_numpy(), packed, ids, leads, k)
        return pa.table({
            "query_no": pa.array(q["no"].to_numpy()[row], pa.int64()), "query_id": pa.array(q["id"].to_numpy()[row], pa.int64()),
            "no": pa.array(c["no"].to_numpy()[col], pa.int64()), "vec_id": pa.array(ids[col], pa.int64()),
            "lead": pa.array(leads[col], pa.bool_()), "low": pa.array(low, pa.float64()), "high": pa.array(high, pa.float64()),
        })

    schema = "query_no long, query_id long, no long, vec_id long, lead boolean, low double, high double"
    blocks_of = queries.unionByName(there).groupBy("block", "group", "dim")
    pairs = stored(blocks_of.applyInArrow(scan, schema))

    def kth(scored: DataFrame, score: str, name: str) -> DataFrame:
        """The k-th greatest of each query's candidates; of queries with fewer there is none."""
        each = scored.groupBy("query_id", "vec_id").agg(F.max(score).alias(score))
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(score)))
        return each.withColumn("place", place).filter(F.col("place") <= k).groupBy("query_id").agg(
            F.when(F.count("*") == k, F.min(score)).alias(name)
        )

    def still(rows: DataFrame, limits: DataFrame, name: str) -> DataFrame:
        return rows.join(limits, "query_id", "left").filter(F.col(name).isNull() | (F.col("high") >= F.col(name))).drop(name)

    left = still(pairs, kth(pairs.filter("lead"), "low", "sure"), "sure")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("high"), "vec_id", "no", "query_no"))
    left = stored(left.select("query_no", "query_id", "no", "vec_id", "high").withColumn("place", place))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = np.zeros(len(b), np.int64)
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = dims == dim
                mask = pa.array(own)
                scores[own] = inner_products(whole(b.column("asked").filter(mask)), whole(b.column("vector").filter(mask)))
            yield batch({"query_id": b.column("query_id"), "vec_id": b.column("vec_id"), "score": pa.array(scores, pa.int64())})

    def read(some: DataFrame) -> DataFrame:
        exact = some.join(rows.select("no", "vector", "dim"), "no")
        exact = exact.join(rows.filter("is_query").select(F.col("no").alias("query_no"), F.col("vector").alias("asked")), "query_no")
        return exact.select("query_id", "vec_id", "dim", "asked", "vector").mapInArrow(products, "query_id long, vec_id long, score long")

    first = stored(read(left.filter(F.col("place") <= FIRST * k)))
    more = read(still(left.filter(F.col("place") > FIRST * k), kth(first, "score", "found"), "found"))
    best = first.unionByName(more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
