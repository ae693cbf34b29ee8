"""Exact quantiles of many columns at once, in a fixed number of passes with bounded memory per task.

The built-in exact aggregates keep every distinct value of a column in one task.  Here
a double is read as 64 bits whose order as an unsigned number is that of the values, and
the value at a rank is found digit by digit from the highest on:

* A pass counts the digits that follow what is already known of each wanted value, for
  all columns and probabilities together.  A task counts in arrays and emits one row per
  digit it has seen.
* The sums of these rows, running over the digits of one prefix, tell in which digit the
  rank lies and how many rows are below; only those two numbers reach the driver, and of the
  first pass the counts by sign and exponent, at most 4,096 a column, which give the ranks.

Five digits make a double, so every column takes five passes, whatever its type, its
range, the number of its rows or how often a value repeats.  The minimum and the maximum
are the first and the last rank of the same search.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perennia.functions import field
from perennia.sources.schema import small_table

BITS = 64
FIRST, DIGIT = 12, 13  # bits of the first digit (sign and exponent) and of the others; the last one has the rest
CELLS = 4_000_000  # counters a task holds before it emits them
_COUNTS = "place int, digit int, n long"


@dataclass(frozen=True)
class ColumnQuantiles:
    """Count, extremes and quantile values of a column; NaN and null take no part.

    ``between`` counts the values other than the minimum and the maximum.
    """

    name: str
    count: int
    minimum: float | None
    maximum: float | None
    between: int
    values: dict[float, float | None]

    @property
    def two_valued(self) -> bool:
        return self.count > 0 and self.between == 0


@dataclass
class _Search:
    """The value at a rank of one column: the first bits of it, and its rank among the rows that share them."""

    column: int
    wanted: int  # rank among all rows
    rank: int
    prefix: int = 0
    same: int = 0  # rows with these first bits


def fit_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), *, digit: int = DIGIT
) -> list[ColumnQuantiles]:
    """Smallest value whose cumulative share of the rows reaches each probability.

    Reads ``df`` once for the first digit and once for each following one of ``digit`` bits, five times by default; a table that is
    costly to compute is better stored before.  Values are compared as doubles, and the two
    zeros are one value.
    """
    cols, probs = list(cols), list(probs)
    if not cols:
        return []
    values = df.select(*[field(name).cast("double").alias(f"v{c}") for c, name in enumerate(cols)])
    # of each column the wanted ranks; the first and the last one give the extremes
    places = [(c, 0) for c in range(len(cols))]
    shift = BITS - FIRST
    first = _digit_counts(values, places, shift, FIRST).groupBy("place", "digit").agg(F.sum("n").alias("n")).collect()
    sizes: Counter[int] = Counter()
    for row in first:
        sizes[row.place] += row.n
    searches = [_Search(c, r, r) for c, n in sizes.items() for r in sorted({1, n, *(_rank(p, n) for p in probs)})]
    _advance(small_table(df.sparkSession, [row.asDict() for row in first], _COUNTS), places, searches, FIRST)
    while shift:
        bits = min(digit, shift)
        shift -= bits
        places = sorted({(s.column, s.prefix) for s in searches})
        _advance(_digit_counts(values, places, shift, bits), places, searches, bits)
    found = {(s.column, s.wanted): s for s in searches}
    return [_fitted(name, sizes[c], probs, c, found) for c, name in enumerate(cols)]


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), **options) -> DataFrame:
    """(column_name, prob, value)"""
    rows = [
        {"column_name": q.name, "prob": p, "value": q.values[p]}
        for q in fit_quantiles(df, cols, probs, **options)
        for p in probs
    ]
    return small_table(df.sparkSession, rows, "column_name string, prob double, value double")


def _rank(prob: float, n: int) -> int:
    return max(1, math.ceil(Fraction(str(prob)) * n))


def _fitted(name: str, n: int, probs: list[float], c: int, found: dict[tuple[int, int], _Search]) -> ColumnQuantiles:
    if not n:
        return ColumnQuantiles(name, 0, None, None, 0, dict.fromkeys(probs))
    first, last = found[c, 1], found[c, n]
    between = n - first.same - last.same if first.prefix != last.prefix else 0
    answers = {p: _double(found[c, _rank(p, n)].prefix) for p in probs}
    return ColumnQuantiles(name, n, _double(first.prefix), _double(last.prefix), between, answers)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers of the same order; both zeros are the same number."""
    bits = (values + 0.0).view(np.uint64)
    top = np.uint64(1 << 63)
    return np.where(bits & top, ~bits, bits | top)


def _double(ordered: int) -> float:
    top = 1 << 63
    bits = ordered ^ top if ordered & top else ~ordered & (2 * top - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _digit_counts(values: DataFrame, places: list[tuple[int, int]], shift: int, bits: int) -> DataFrame:
    """(place, digit, n): present values per digit, of those whose bits above it are the place's prefix.

    A task may emit a place and digit several times, since it holds ``CELLS`` counters at most.
    """
    width, most = 1 << bits, max(1, CELLS >> bits)
    by_column: dict[int, list[tuple[int, int]]] = {}
    for place, (column, prefix) in enumerate(places):
        by_column.setdefault(column, []).append((place, prefix))
    whole = shift + bits == BITS

    def emitted(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for place, counted in held.items():
            (seen,) = np.nonzero(counted)
            columns = [pa.array(np.full(len(seen), place, np.int32)), pa.array(seen.astype(np.int32)), pa.array(counted[seen])]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "digit", "n"])
        held.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for column, wanted in by_column.items():
                x = batch[column].drop_null().to_numpy(zero_copy_only=False)
                ordered = _ordered(x[~np.isnan(x)])
                above = None if whole else ordered >> np.uint64(shift + bits)
                for place, prefix in wanted:
                    own = ordered if whole else ordered[above == np.uint64(prefix)]
                    if not len(own):
                        continue
                    digits = (own >> np.uint64(shift)) & np.uint64(width - 1)
                    counted = np.bincount(digits.astype(np.int64), minlength=width)
                    if place in held:
                        held[place] += counted
                    else:
                        if len(held) >= most:
                            yield from emitted(held)
                        held[place] = counted
        yield from emitted(held)

    return values.mapInArrow(count, _COUNTS)


def _advance(counts: DataFrame, places: list[tuple[int, int]], searches: list[_Search], bits: int) -> None:
    """Add a digit to what is known of every wanted value."""
    number = {place: k for k, place in enumerate(places)}
    goals = small_table(
        counts.sparkSession,
        [{"s": k, "g": number[s.column, s.prefix], "rank": s.rank} for k, s in enumerate(searches)],
        "s int, g int, rank long",
    )
    running = Window.partitionBy("place").orderBy("digit")
    summed = counts.groupBy("place", "digit").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(running))
    reached = summed.join(F.broadcast(goals), F.col("place") == F.col("g")).filter(F.col("upto") >= F.col("rank"))
    first = reached.groupBy("place", "s").agg(F.min(F.struct("digit", "n", "upto")).alias("at"))
    for row in first.select("s", "at.*").collect():
        search = searches[row.s]
        search.prefix = search.prefix << bits | row.digit
        search.rank -= row.upto - row.n
        search.same = row.n
