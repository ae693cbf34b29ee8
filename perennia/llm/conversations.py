"""Repair of conversations: the cheapest edits after which roles alternate.

Each row of a conversation is a symbol: its role's initial and its fault.  Equal consecutive symbols are one run.  What
a row can do to the four states of a good conversation (nothing yet, after the system row, after a user row, after an
assistant row) is a 4 x 4 matrix of costs; a run's matrix is a product, in (min, +), of binary powers that are computed
once for a symbol.  Going back over the runs gives what the rest costs from each state; going forward again, the
least letter that still reaches the least cost is the next edit.

Rows are range-partitioned by conversation and turn, so a conversation of any length is spread over tasks.  A task
finishes the conversations that lie inside its range.  Of those at its two ends it keeps runs and matrix; they are at
most two a task, are put together on the driver as a few numbers each, and only the digest of such a conversation's
text, which depends on all that comes before, is made by one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import batch
from perennia.sources.scratch import stored

# What edits cost.
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
#: States are 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.
STATES = range(4)
#: The state after a user or assistant row that an edit chose.
NEXT = (2, 2, 3, 2)
ROLE_OF = {2: "user", 3: "assistant"}
FAR = 1 << 60
#: What is left to pay after the last row: a conversation is empty or ends with the assistant.
END = (0, 2 * INSERT, INSERT, 0)
#: Symbols are 2 * role + (1 if truncated), for the roles s, u, a and others; rows that must go are ``GONE``.
INITIALS, GONE = "sua", 8
LEGAL = frozenset(("su", "ua", "au"))
#: Conversations of at most so many runs share what was found for the same runs.
SHORT = 64
#: Rows and characters of an output batch.
ROWS, CHARS = 2000, 1 << 20

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]
Run = tuple[int, int]


def kept_state(symbol: int, state: int) -> int | None:
    """The state after a row that stays as it is, if it may."""
    role = symbol // 2
    if symbol == GONE or role == 3:
        return None
    if role == 0:
        return 1 if state == 0 else None
    return role + 1 if NEXT[state] == role + 1 else None


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(FAR, *(a[i][k] + v[k] for k in STATES)) for i in STATES)


IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)


@lru_cache(maxsize=None)  # nine symbols
def step(symbol: int) -> Matrix:
    """Costs from state to state of any inserts and then one row."""
    inserts = [[0 if i == j else FAR for j in STATES] for i in STATES]
    for i in STATES:
        inserts[i][NEXT[i]] = INSERT
    closure = product(tuple(map(tuple, inserts)), tuple(map(tuple, inserts)))
    row = [[FAR] * 4 for _ in STATES]
    for s in STATES:
        row[s][s] = DELETE
        if symbol != GONE:
            late = UNFINISHED * (symbol % 2)
            row[s][NEXT[s]] = min(row[s][NEXT[s]], REROLE + late)
            kept = kept_state(symbol, s)
            if kept is not None:
                row[s][kept] = min(row[s][kept], KEEP + late)
    return product(closure, tuple(map(tuple, row)))


@lru_cache(maxsize=None)  # nine symbols, at most 63 powers each
def power(symbol: int, bit: int) -> Matrix:
    """The matrix of ``2 ** bit`` equal rows."""
    if bit == 0:
        return step(symbol)
    half = power(symbol, bit - 1)
    return product(half, half)


def bits(count: int) -> Iterator[int]:
    return (b for b in range(count.bit_length()) if count >> b & 1)


def matrix_of(runs: list[Run]) -> Matrix:
    total = IDENTITY
    for symbol, count in runs:
        for b in bits(count):
            total = product(total, power(symbol, b))
    return total


def back_over(runs: list[Run], end: Vector) -> list[Vector]:
    """What the rest costs from each state, before each run and after the last."""
    out = [end]
    for symbol, count in reversed(runs):
        v = out[-1]
        for b in bits(count):
            v = applied(power(symbol, b), v)
        out.append(v)
    return out[::-1]


def unrolled(runs: list[Run], end: Vector, state: int, last: bool) -> tuple[str, int]:
    """The edits' initials, least in ASCII order among the cheapest, and the state they end in."""
    letters: list[str] = []
    rest = back_over(runs, end)
    for at, (symbol, count) in enumerate(runs):
        ahead = [rest[at + 1]]  # by the rows of the run that are left
        for _ in range(count):
            ahead.append(applied(step(symbol), ahead[-1]))
        late = UNFINISHED * (symbol % 2)
        for left in range(count, 0, -1):
            now, then = ahead[left], ahead[left - 1]
            while True:
                cost, put = now[state], NEXT[state]
                if cost == DELETE + then[state]:
                    letters.append("D")
                    break
                if cost == INSERT + now[put]:
                    letters.append("I")
                    state = put
                    continue
                kept = kept_state(symbol, state)
                if kept is not None and cost == KEEP + late + then[kept]:
                    letters.append("K")
                    state = kept
                else:
                    letters.append("R")
                    state = put
                break
    while last and END[state]:
        letters.append("I")
        state = NEXT[state]
    return "".join(letters), state


@lru_cache(maxsize=1 << 14)
def _known(runs: tuple[Run, ...]) -> tuple[int, str]:
    return back_over(list(runs), END)[0][0], unrolled(list(runs), END, 0, True)[0]


def cheapest(runs: list[Run]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    if len(runs) <= SHORT and all(n <= SHORT for _, n in runs):
        return _known(tuple(runs))
    return _known.__wrapped__(tuple(runs))


class Walk:
    """Rows in, turns of the repaired conversation out, along an audit."""

    def __init__(self) -> None:
        self.state = 0

    def inserted(self) -> tuple[str, str]:
        self.state = NEXT[self.state]
        return ROLE_OF[self.state], ""

    def edited(self, letter: str, role: str, text: str) -> tuple[str, str] | None:
        if letter == "D":
            return None
        if letter == "R":
            self.state = NEXT[self.state]
            return ROLE_OF[self.state], text
        self.state = 1 if role[:1] == "s" else NEXT[self.state]
        return role, text


@dataclass
class Part:
    """What one task has of one conversation.  ``rows`` are (role, text, copies)."""

    id: object
    rows: list[tuple[str, str, int]] = field(default_factory=list)
    runs: list[Run] = field(default_factory=list)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    latest: str | None = None
    least: int | None = None
    most: int | None = None
    turns: int = 0

    def run(self, symbol: int, count: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1] = (symbol, self.runs[-1][1] + count)
        elif count:
            self.runs.append((symbol, count))

    def add(self, turn: int | None, role: str, text: str, copies: int, repeated: bool, blank: bool, truncated: bool) -> None:
        if not copies:
            return  # a row that is gone keeps its conversation
        self.rows.append((role, text, copies))
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        initial = role[:1]
        if self.latest is None:
            self.first = initial
        elif self.latest + initial not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1
        self.latest = initial
        if blank:
            self.blank += copies
            self.run(GONE, copies)
        elif repeated:
            self.duplicate += copies
            self.run(GONE, copies)
        else:
            self.truncated += truncated
            role_number = INITIALS.find(initial) if initial else -1
            self.run(2 * (role_number if role_number >= 0 else 3) + truncated, 1)
            self.duplicate += copies - 1
            self.run(GONE, copies - 1)

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns


def joined(parts: list[Part]) -> Part:
    """The counts of consecutive parts of one conversation as one; rows and runs stay apart."""
    total = Part(parts[0].id)
    for p in parts:
        total.blank += p.blank
        total.duplicate += p.duplicate
        total.truncated += p.truncated
        total.illegal += p.illegal
        if p.first is not None:
            total.illegal += total.latest is not None and total.latest + p.first not in LEGAL
            total.latest = p.latest
        if p.least is not None:
            total.least = p.least if total.least is None else total.least
            total.turns += p.turns - (total.most == p.least)
            total.most = p.most
    return total


class Out:
    """Rows of the first pass: finished conversations (no part), and rows and summaries of those at the ends of a task."""

    NAMES = ("id", "part", "seq", "role", "text", "copies", "facts", "runs", "audit", "digest")

    def __init__(self, id_type: pa.DataType):
        self.types = (
            id_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
            pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string(), pa.string(),
        )
        self.rows: list[tuple] = []
        self.chars = 0

    @staticmethod
    def ddl(id_type: str) -> str:
        return (
            f"id {id_type}, part long, seq long, role string, text string, copies long, "
            "facts array<long>, runs array<long>, audit string, digest string"
        )

    def add(self, id, part=None, seq=None, role=None, text=None, copies=None, facts=None, runs=None, audit=None, digest=None):
        self.rows.append((id, part, seq, role, text, copies, facts, runs, audit, digest))
        self.chars += len(text or "") + len(audit or "")

    def full(self) -> bool:
        return len(self.rows) >= ROWS or self.chars >= CHARS

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.NAMES)
        self.rows, self.chars = [], 0
        return batch({n: pa.array(c, t) for n, c, t in zip(self.NAMES, columns, self.types, strict=True)})


def numbered(initial: str | None) -> int | None:
    return None if initial is None else (ord(initial) if initial else -1)


def lettered(number: int | None) -> str | None:
    return None if number is None else ("" if number < 0 else chr(number))


def finished(part: Part, out: Out, turns: bool) -> None:
    cost, audit = cheapest(part.runs)
    walk, digest, number = Walk(), hashlib.sha256(), 0
    letters = iter(audit)

    def write(turn: tuple[str, str], letter: str) -> None:
        nonlocal number
        if turns:
            out.add(part.id, seq=number, role=turn[0], text=turn[1], audit=letter)
        else:
            digest.update(("\n" if number else "").encode() + f"{turn[0]}:{turn[1]}".encode())
        number += 1

    for role, text, copies in part.rows:
        for _ in range(copies):
            while (letter := next(letters)) == "I":
                write(walk.inserted(), "I")
            if turn := walk.edited(letter, role, text):
                write(turn, letter)
    for _ in letters:
        write(walk.inserted(), "I")
    if not turns:
        facts = [part.gaps(), part.blank, part.duplicate, part.truncated, part.illegal, cost]
        out.add(part.id, facts=facts, audit=audit, digest=digest.hexdigest())


def at_an_end(part: Part, out: Out, number: int) -> Iterator[pa.RecordBatch]:
    """The rows of a conversation that may go on in another task, and its summary."""
    for k, (role, text, copies) in enumerate(part.rows):
        out.add(part.id, number, k, role, text, copies)
        if out.full():
            yield out.taken()
    facts = [part.blank, part.duplicate, part.truncated, part.illegal, numbered(part.first), numbered(part.latest)]
    facts += [part.least, part.most, part.turns, *(x for row in matrix_of(part.runs) for x in row)]
    out.add(part.id, number, -1, facts=facts, runs=[x for run in part.runs for x in run])


def summary(row) -> tuple[Part, Matrix]:
    blank, duplicate, truncated, illegal, first, latest, least, most, turns, *costs = row["facts"]
    part = Part(row["id"], [], [], blank, duplicate, truncated, illegal, lettered(first), lettered(latest), least, most, turns)
    return part, tuple(tuple(costs[4 * i : 4 * i + 4]) for i in STATES)


def in_order(rows: DataFrame) -> DataFrame:
    """One row for all equal ones with their number, in order, with what a task must know of other rows."""
    space = F.lit(" \t\n\x0b\f\r")
    counted = rows.groupBy("id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    counted = counted.withColumns(
        {"own": F.struct(F.col("turn").isNotNull().alias("there"), "turn"), "same": F.sha2("text", 256), "tail": F.rtrim("text", space)}
    )
    there = counted.filter((F.col("copies") > 0) & (F.col("tail") != "")).groupBy(
        F.col("id").alias("id_"), F.col("role").alias("role_"), F.col("same").alias("same_")
    )
    first = there.agg(F.min("own").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    on = counted["id"].eqNullSafe(first["id_"]) & (counted["role"] == first["role_"]) & (counted["same"] == first["same_"])
    marked = counted.join(first, on, "left").select(
        "id", "turn", "role", "text", "copies",
        F.coalesce(F.col("own") > F.col("first"), F.lit(False)).alias("repeated"),
        (F.col("tail") == "").alias("blank"),
        (~F.substring("tail", -1, 1).isin(".", "!", "?") & (F.col("tail") != "")).alias("truncated"),
    )
    order = [F.col("id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    dealt = marked.repartitionByRange(*order, F.substring("text", 1, 64).asc())
    return dealt.sortWithinPartitions(*order, F.col("text").asc())


def repair(
    conversations: DataFrame, copies: Column | int = 1, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *, turns: bool = False
) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    With ``turns``: the repaired conversations themselves, ``id, number (from 0), edit, role, text``.

    ``copies`` says how often a row is there; a conversation whose rows are all there 0 times is still in the report,
    with zeros, an empty audit and the digest of an empty text.  Null roles and texts are one space; rows without a
    conversation id are one conversation.  Rows are taken by turn, nulls first, rows of one turn by role and text, so
    equal rows are next to each other.  A row's fault is the first that holds: blank (nothing but white space),
    duplicate (role and text occurred before) or truncated (its last character that is no white space is not ``.!?``).
    An empty table gives no rows.  Other columns are not looked at.
    """
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col(id).alias("id"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"), (F.lit(copies) if isinstance(copies, int) else copies).cast("long").alias("copies"),
    )
    gone = F.col("copies") == 0  # such rows only keep their conversation
    rows = rows.withColumns(
        {"turn": F.when(~gone, F.col("turn")), "role": F.when(gone, "").otherwise(F.col("role")), "text": F.when(gone, "").otherwise(F.col("text"))}
    )
    id_ddl = conversations.schema[id].dataType.simpleString()

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, part, is_first = TaskContext.get().partitionId(), None, None, True
        for rows in batches:
            out = out or Out(rows.schema.field("id").type)
            for id, *row in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if part is None or part.id != id:
                    if part is not None:
                        if is_first:
                            yield from at_an_end(part, out, 2 * task)
                            is_first = False
                        else:
                            finished(part, out, turns)
                        if out.full():
                            yield out.taken()
                    part = Part(id)
                part.add(*row)
        if part is not None:
            yield from at_an_end(part, out, 2 * task + (not is_first))
            yield out.taken()

    ddl = Out.ddl(id_ddl)
    passed = stored(in_order(rows).mapInArrow(first_pass, ddl))
    done, ends = passed.filter("part is null"), passed.filter("part is not null")

    # at most two rows a task of the first pass, a few numbers each
    known: dict[object, list] = {}
    for row in sorted(ends.filter("seq = -1").select("id", "part", "facts").collect(), key=lambda r: r["part"]):
        known.setdefault(row["id"], []).append((row["part"], *summary(row)))
    after: dict[int, Vector] = {}  # part: what the rest costs after it
    facts: dict[object, list[int]] = {}
    last: set[int] = set()
    for id_, parts in known.items():
        v = END
        last.add(parts[-1][0])
        for number, _, costs in reversed(parts):
            after[number] = v
            v = applied(costs, v)
        total = joined([p for _, p, _ in parts])
        facts[id_] = [total.gaps(), total.blank, total.duplicate, total.truncated, total.illegal, v[0]]

    sent = spark.sparkContext.broadcast(after)

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state after a part, for each state before it."""
        for rows in batches:
            numbers, states = rows.column("part").to_pylist(), []
            for number, flat in zip(numbers, rows.column("runs").to_pylist(), strict=True):
                runs = list(zip(flat[::2], flat[1::2], strict=True))
                states.append([unrolled(runs, sent.value[number], s, False)[1] for s in STATES])
            yield batch({"part": pa.array(numbers, pa.int64()), "states": pa.array(states, pa.list_(pa.int64()))})

    several = [n for parts in known.values() if len(parts) > 1 for n, _, _ in parts]
    summaries = ends.filter("seq = -1").select("id", "part", "runs")
    through = {}
    if several:
        through = {r["part"]: r["states"] for r in summaries.select("part", "runs").mapInArrow(ways, "part long, states array<long>").collect()}
    begin: dict[int, int] = {}
    for parts in known.values():
        state = 0
        for number, _, _ in parts:
            begin[number] = state
            state = through[number][state] if len(parts) > 1 else state
    placed = spark.sparkContext.broadcast((after, begin, last))

    def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends_after, states, closing = placed.value
        for rows in batches:
            out = Out(rows.schema.field("id").type)
            for id, number, flat in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                runs = list(zip(flat[::2], flat[1::2], strict=True))
                audit, _ = unrolled(runs, ends_after[number], states[number], number in closing)
                out.add(id, number, -1, audit=audit)
            yield out.taken()

    counts = spark.sparkContext.broadcast(facts)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, walk, letters = None, None, Walk(), ""
        used, number, pieces, digest = 0, 0, [], hashlib.sha256()

        def write(turn: tuple[str, str], letter: str) -> None:
            nonlocal number
            if turns:
                out.add(at[0], seq=number, role=turn[0], text=turn[1], audit=letter)
            else:
                digest.update(("\n" if number else "").encode() + f"{turn[0]}:{turn[1]}".encode())
            number += 1

        def rest() -> None:
            """Inserts after the last row of a part."""
            nonlocal used
            while used < len(letters):
                write(walk.inserted(), "I")
                used += 1

        def close() -> None:
            rest()
            if not turns:
                out.add(at[0], facts=counts.value[at[0]], audit="".join(pieces), digest=digest.hexdigest())

        for rows in batches:
            out = out or Out(rows.schema.field("id").type)
            columns = (rows.column(n).to_pylist() for n in ("id", "seq", "role", "text", "copies", "audit"))
            for id, seq, role, text, copies, audit in zip(*columns, strict=True):
                if at is None or at[0] != id:
                    if at is not None:
                        close()
                    at, walk, letters, used, number, pieces, digest = (id,), Walk(), "", 0, 0, [], hashlib.sha256()
                if seq == -1:
                    rest()
                    letters, used = audit, 0
                    pieces.append(audit)
                    continue
                for _ in range(copies):
                    while (letter := letters[used]) == "I":
                        write(walk.inserted(), "I")
                        used += 1
                    used += 1
                    if turn := walk.edited(letter, role, text):
                        write(turn, letter)
                if out.full():
                    yield out.taken()
        if at is not None:
            close()
            yield out.taken()

    pieces = summaries.mapInArrow(audits, ddl).select("id", "part", "seq", "role", "text", "copies", "audit")
    edge = ends.filter("seq >= 0").select("id", "part", "seq", "role", "text", "copies", "audit").unionByName(pieces)
    whole = done.unionByName(edge.repartition("id").sortWithinPartitions("id", "part", "seq").mapInArrow(stream, ddl))
    if turns:
        return whole.select(F.col("id").alias(id), F.col("seq").alias("number"), F.col("audit").alias("edit"), "role", "text")
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return whole.select(
        F.col("id").alias(id), *[F.col("facts")[k].alias(n) for k, n in enumerate(names)], "audit", F.col("digest").alias("repaired_sha256")
    )


def damage(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, Column]:
    """Rows with faults that a hash of id and turn (nulls: one space) chooses, and how often each row is there.

    Of twenty remainders, 0 drops a row, 1 empties its text, 2 takes ``.!?`` out, 3 repeats it and 4 makes it a user's.
    """
    one = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col(id).cast("string"), one), F.coalesce(F.col(turn).cast("string"), one))
    fault = F.pmod(F.crc32(key), F.lit(20))
    own = F.coalesce(F.col(text), one)
    changed = conversations.select(
        id, turn, F.when(fault == 4, "user").otherwise(F.coalesce(F.col(role), one)).alias(role),
        F.when(fault == 1, "").when(fault == 2, F.translate(own, ".!?", "")).otherwise(own).alias(text),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )
    return changed, F.col("copies")
