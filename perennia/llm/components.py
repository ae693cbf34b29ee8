"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.sources.scratch import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least.hint("merge"), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root is the least node reachable.

    Links may be repeated and in either direction; a link of a node to itself or with a null says nothing.  Each
    round is written to the scratch folder; their number grows with the logarithm of the longest path.  Both sides of
    a round's joins are dealt by node anyway; as broadcasts, two a round, they would only fill the driver's memory.
    """
    edges = stored(links.select("a", "b").filter("a <> b"))
    before = None
    while True:
        edges = stored(_small(_large(edges)))
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if state == before or not state["n"]:
            break
        before = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def forest(linked: np.ndarray) -> np.ndarray:
    """The least row reachable from each row of a matrix of links; within one task."""
    roots = np.arange(len(linked))
    while True:
        low = np.where(linked, roots[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(roots, low)
        new = np.minimum(new, new[new])
        if (new == roots).all():
            return roots
        roots = new
