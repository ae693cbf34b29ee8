"""Exact nearest neighbours by a block matrix join on quantised tiles.

Queries and candidates are dealt into blocks; each cell holds one block of either.  In a cell, vectors are rounded to
int8 with a scale of their own, and one product of int8 tiles gives all distances up to the known rounding errors of the
two vectors.  Only pairs that can still be among the nearest are computed again from the original vectors in double
precision; a heap for each query keeps the best, and the heaps of a query's cells are merged at the end.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from perennia.llm.vectors import matrix, usable
from perennia.sources.scratch import stored

#: Queries and candidates of a cell, and candidates of a tile.
QUERY_BLOCK, CANDIDATE_BLOCK, TILE = 512, 8192, 1024


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 components, scales, and lengths of what rounding left out."""
    scales = np.abs(vectors).max(axis=1) / 127
    scales = np.where(scales > 0, scales, 1.0)
    small = np.rint(vectors / scales[:, None]).astype(np.int8)
    return small, scales, np.sqrt(((vectors - small * scales[:, None]) ** 2).sum(axis=1))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, summed component by component in double precision."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += (a[:, k] - b[:, k]) ** 2
    return np.sqrt(total)


def tile_bounds(q: tuple, c: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distances of all pairs of two quantised blocks."""
    (q8, qs, qe), (c8, cs, ce) = q, c
    # whole numbers below 2 ** 24 are exact in single precision
    exact = np.float32 if q8.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (q8.astype(exact) @ c8.astype(exact).T).astype(np.float64)
    squares = [((x.astype(np.float64) ** 2).sum(axis=1) * s * s) for x, s in ((q8, qs), (c8, cs))]
    about = squares[0][:, None] + squares[1][None, :] - 2 * (qs[:, None] * cs[None, :]) * product
    about = np.sqrt(np.maximum(about, 0))
    error = qe[:, None] + ce[None, :] + 1e-6 * (1e-30 + np.sqrt(squares[0])[:, None] + np.sqrt(squares[1])[None, :])
    return np.maximum(about - error, 0), about + error


def nearest_in_cell(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, neighbour, distance) of the k nearest ids of a cell for each query; a query's own id is left out."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]  # (-distance, -id), the worst first
    held: list[dict[int, float]] = [{} for _ in query_ids]  # the ids of each heap
    order = np.argsort(ids, kind="stable")  # rows of one id are neighbours
    ids, vectors = ids[order], vectors[order]
    q = quantised(queries)
    for at in range(0, len(ids), TILE):
        own, tile = ids[at : at + TILE], vectors[at : at + TILE]
        low, high = tile_bounds(q, quantised(tile))
        same = query_ids[:, None] == own[None, :]
        high[same] = low[same] = np.inf
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        if len(starts) < len(own):  # an id's upper bound is the least of its rows'
            high = np.minimum.reduceat(high, starts, axis=1)
        # among k + 1 upper bounds that are finite, the k-th is an upper bound of the k-th distance
        limit = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] >= k else np.full(len(high), np.inf)
        worst = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps])
        limit = np.minimum(limit, worst)
        row, col = np.nonzero((low <= limit[:, None]) & ~same)
        for i, j, d in zip(row.tolist(), col.tolist(), distances(queries[row], tile[col]).tolist(), strict=True):
            heap, near, other = heaps[i], held[i], int(own[j])
            entry = (-d, -other)
            if other in near:  # an id has one entry, its least distance
                if d < near[other]:
                    heap[heap.index((-near[other], -other))] = entry
                    heapq.heapify(heap)
                    near[other] = d
            elif len(heap) < k:
                heapq.heappush(heap, entry)
                near[other] = d
            elif entry > heap[0]:
                del near[-heapq.heapreplace(heap, entry)[1]]
                near[other] = d
    return [(int(query), -i, -d) for query, heap in zip(query_ids, heaps, strict=True) for d, i in heap]


def _sizes(rows: DataFrame) -> Row:
    """Rows, queries among them, and most rows of one id."""
    each = rows.groupBy("id").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q"))
    return each.agg(F.sum("n").alias("n"), F.sum("q").alias("q"), F.max("n").alias("most")).first()


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` nearest other rows of each row where ``is_query`` holds.

    Nearest first, ties to the smaller id; fewer rows if there are fewer candidates.  Rows with a null id, and vectors
    that are null, empty, zero or hold null or non-finite components, take no part.  Vectors of other lengths than the query's are
    no candidates.  Rows of one id count as one candidate, at the least of their distances.
    """
    rows = vectors.withColumn("is_query", is_query).select(
        F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), "is_query"
    )
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))
    sizes = _sizes(rows)
    if (sizes["most"] or 0) > 1:  # vectors are dealt by id and vector only where ids repeat
        rows = stored(rows.groupBy("id", "vector", "dim").agg(F.max("is_query").alias("is_query")))
        sizes = _sizes(rows)
    groups, blocks = -(-(sizes["n"] or 0) // CANDIDATE_BLOCK) or 1, -(-(sizes["q"] or 0) // QUERY_BLOCK) or 1
    number = F.xxhash64("id")
    asked = rows.filter("is_query").select(
        F.lit(True).alias("asks"), F.pmod(number, F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), "dim", "id", "vector",
    )
    there = rows.select(
        F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(number, F.lit(groups)).alias("group"), "dim", "id", "vector",
    )

    def cell(rows: pa.Table) -> pa.Table:
        asks = rows["asks"].to_numpy(zero_copy_only=False).astype(bool)
        ids, all_vectors = rows["id"].to_numpy(), matrix(rows["vector"])
        found = nearest_in_cell(ids[asks], all_vectors[asks], ids[~asks], all_vectors[~asks], k)
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, types, strict=True)})

    cells = asked.unionByName(there).groupBy("block", "group", "dim")
    found = cells.applyInArrow(cell, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
