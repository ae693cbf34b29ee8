"""Best-fit packing of token sequences with swap-based local search.

Documents are cut only where they are longer than a sequence.  Full pieces are sequences of their own.  The other
pieces are dealt at random, by a hash, into groups of about ``GROUP`` pieces; each group is packed best-fit
decreasing and then improved: bins that are not full exchange one piece for one or for two, or move a piece, as long
as the sum of squared fills grows; bins that lose their last piece vanish.  What stays in the bins that are still
below ``SPARSE`` of a sequence is dealt into fewer groups and packed again, until one round leaves a single group.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.llm.bpe import LONG, codec, encoded_pieces
from perennia.llm.common import batch, temporary
from perennia.sources.scratch import stored

#: Pieces that one task packs together.
GROUP = 8192
#: Bins filled less than this share are dealt again.
SPARSE = 0.97

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_tokens(
    docs: DataFrame,
    vocabulary: Broadcast,
    capacity: int = 2048,
    end: int = 0,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32 and, if asked for, their ids.

    A document is its token ids and ``end``; a null or empty text is ``end`` alone.  Only documents longer than
    ``capacity`` are cut.
    """
    schema = _PIECES + (", ids array<int>" if with_ids else "")

    def rows(documents: Iterator[tuple[int | None, bytes]]) -> pa.RecordBatch:
        out: list[tuple] = []
        kept: list[np.ndarray] = []
        tail = np.array([end], "<u4").tobytes()
        for doc, ids in documents:
            ids += tail
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                out.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                if with_ids:
                    kept.append(np.frombuffer(part, "<u4").astype(np.int32))
        columns = list(zip(*out, strict=True)) or [()] * 5
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "piece", "start", "length", "ids_crc32")
        made = {n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)}
        return batch(made | ({"ids": pa.array(kept, pa.list_(pa.int32()))} if with_ids else {}))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(vocabulary)
        for b in batches:
            yield rows((d, one.encode(t)) for d, t in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True))

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(vocabulary)  # joined and cut by one worker: a second one would hold the vocabulary again
        for b in batches:
            yield rows((d, one.joined(t.as_py())) for d, t in zip(b[0].to_pylist(), b[1], strict=True))

    own = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.length("text"), F.lit(0)) > LONG
    dealt = encoded_pieces(own.filter(is_long), vocabulary, "text", "pieces").select("doc_id", "pieces")
    return own.filter(~is_long).mapInArrow(short, schema).unionByName(dealt.mapInArrow(long, schema))


def pack(
    pieces: DataFrame, capacity: int = 2048, length: str = "length", group: int = GROUP, sparse: float = SPARSE
) -> DataFrame:
    """``pieces`` with sequence_id and offset (columns of these names are replaced).

    Every row gets a place, repeated rows as well; a row without a length or of length 0 gets null, as there is
    nothing to place; a row longer than ``capacity`` is an error.  Offsets are gapless from 0, sequence numbers are
    any numbers.  Runs one job for each round, over tables of lengths.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    number, offset = F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset")
    table = stored(pieces.select(columns))
    size = F.coalesce(F.col(f"`{length}`"), F.lit(0))
    too_long = F.raise_error(F.concat(F.lit("a piece is longer than a sequence: "), size.cast("string"))).cast("long")
    done = table.filter(size <= 0).select("*", number, offset)
    done = done.unionByName(
        table.filter(size >= capacity).select(
            "*",
            F.when(size > capacity, too_long).otherwise(-1 - F.monotonically_increasing_id()).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    schema, key = done.schema, temporary("group")
    left, turn = table.filter((size > 0) & (size < capacity)), 0
    while True:
        count = left.count()
        groups = max(1, -(-count // group))
        first = turn << 57  # sequences are numbered by round, group and place in the group

        def packed(which: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            sequences, offsets = pack_group(rows[length].to_numpy(np.int64), capacity)
            return rows.drop(columns=key).assign(sequence_id=first + (int(which[0]) << 24) + sequences, offset=offsets)

        dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(groups))
        result = stored(left.withColumn(key, dealt).groupBy(key).applyInPandas(packed, schema))
        if groups == 1:
            return done.unionByName(result)
        fill = result.groupBy("sequence_id").agg(F.sum(size).alias(key), F.count("*").alias("n"))
        fill = stored(fill.filter(F.col(key) < sparse * capacity))
        of = fill.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pieces"), F.percentile_approx(key, 0.5).alias("middle")).first()
        if of["pieces"] > 0.9 * count:  # most lengths fill no sequence: deal the emptier half of the sequences
            fill = fill.filter(F.col(key) < of["middle"])
        sequences = fill.select("sequence_id")
        loose = stored(result.join(sequences, "sequence_id", "left_semi").select(result.columns))
        done = done.unionByName(result.join(sequences, "sequence_id", "left_anti").select(result.columns))
        left, turn = loose.select(columns), turn + 1


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each length and its place there."""
    bins = _best_fit(lengths.tolist(), capacity)
    least = -(-int(lengths.sum()) // capacity)
    while len(bins) > least and _exchange(bins, lengths.tolist(), capacity):
        bins = [b for b in bins if b]
    sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, members in enumerate(b for b in bins if b):
        at = 0
        for i in members:
            sequences[i], offsets[i] = number, at
            at += lengths[i]
    return sequences, offsets


def _best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # (room, bin), ascending
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(rooms, (lengths[i], -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > lengths[i]:
            insort(rooms, (room - lengths[i], b))
    return bins


def _exchange(bins: list[list[int]], lengths: list[int], capacity: int) -> bool:
    """One round of exchanges; whether the sum of squared fills grew.

    Bins are gone through from the fullest down.  Each takes the piece of an emptier bin that fills it best: as a
    move, for one of its own pieces, or for two of them.  What goes to the fuller bin is longer than what comes
    back, so the squares grow each time.
    """
    fills = [sum(lengths[i] for i in b) for b in bins]
    order = sorted((b for b in range(len(bins)) if fills[b] < capacity), key=lambda b: -fills[b])
    pool = sorted((lengths[i], i) for b in order for i in bins[b])
    where = {i: b for b in order for i in bins[b]}
    grew = False

    def drop(i: int) -> None:
        pool.pop(bisect_left(pool, (lengths[i], i)))

    for b in order:
        for i in bins[b]:
            drop(i)
        while fills[b] < capacity:
            room = capacity - fills[b]
            best: tuple[int, int, tuple[int, ...]] | None = None
            own = {lengths[i]: i for i in bins[b]}
            mine = sorted(own.items())
            offers = [(0, ())] + [(size, (i,)) for size, i in mine]
            offers += [
                (x + y, (i, j)) for n, (x, i) in enumerate(mine) for y, j in mine[n + 1 :]
            ]
            for size, given in offers:
                at = bisect_left(pool, (room + size + 1, -1)) - 1
                if at < 0:
                    continue
                gain, taken = pool[at][0] - size, pool[at][1]
                if gain > 0 and (best is None or gain > best[0]):
                    # two pieces must fit where the one was; they do, as they are shorter together
                    best = (gain, taken, given)
                    if gain == room:
                        break
            if best is None:
                break
            gain, taken, given = best
            donor = where[taken]
            drop(taken)
            bins[donor].remove(taken)
            bins[b].append(taken)
            where[taken] = b
            for i in given:
                bins[b].remove(i)
                bins[donor].append(i)
                where[i] = donor
                insort(pool, (lengths[i], i))
            fills[b] += gain
            fills[donor] -= gain
            grew = True
    return grew
