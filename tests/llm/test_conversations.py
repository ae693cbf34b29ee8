"""Conversation repair against a plain search over edits."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perennia.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, copies string, id string"
SPACE = " \t\n\x0b\f\r"


def brute(rows):
    """Report of one conversation's rows (turn, role, text), by a table over rows and states that holds whole audits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        tail = text.rstrip(SPACE)
        faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else "")
        seen.add((role, text))
    put, names = (2, 2, 3, 2), {2: "user", 3: "assistant"}
    best = {}  # (row, state): (cost, audit, lines)

    def better(key, value):
        if key not in best or value < best[key]:
            best[key] = value
            return True
        return False

    ends = {0: (0, "", ()), 3: (0, "", ())}
    for i in range(len(rows), -1, -1):
        for s in range(4):
            if i == len(rows):
                if s in ends:
                    better((i, s), ends[s])
                continue
            _, role, text = rows[i]
            if (i + 1, s) in best:
                c, a, lines = best[i + 1, s]
                better((i, s), (c + 4, "D" + a, lines))
            if faults[i] in ("blank", "duplicate"):
                continue
            late, initial = 3 * (faults[i] == "truncated"), role[:1]
            kept = 1 if initial == "s" and s == 0 else 2 if initial == "u" and s != 2 else 3 if initial == "a" and s == 2 else None
            for letter, to, cost, said in (("K", kept, 0, role), ("R", put[s], 3, names[put[s]])):
                if (i + 1, to) in best:
                    c, a, lines = best[i + 1, to]
                    better((i, s), (c + late + cost, letter + a, ((said, text), *lines)))
        changed = True
        while changed:  # inserts
            changed = False
            for s in range(4):
                if (i, put[s]) in best:
                    c, a, lines = best[i, put[s]]
                    changed |= better((i, s), (c + 3, "I" + a, ((names[put[s]], ""), *lines)))
    cost, audit, lines = best[0, 0]
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [sum(f == x for f in faults) for x in ("blank", "duplicate", "truncated")]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest), lines


def expected(rows):
    groups = {}
    for id, *row in rows:
        groups.setdefault(id, []).append(tuple(row))
    return {id: brute(own) for id, own in groups.items()}


RUNS = st.lists(st.tuples(st.integers(0, 8), st.integers(1, 6)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(RUNS)
def test_runs_by_powers_equal_single_rows(runs):
    v = cv.END
    for symbol, count in reversed(runs):
        for _ in range(count):
            v = cv.applied(cv.step(symbol), v)
    assert cv.back_over(runs, cv.END)[0] == v
    assert cv.applied(cv.matrix_of(runs), cv.END) == v
    cost, audit = cv.cheapest(runs)
    assert cost == v[0] and sum(audit.count(x) for x in "KRD") == sum(n for _, n in runs)


def test_costs_of_the_empty_end():
    assert cv.END == tuple(min(c[0] for c in [(0,)]) if s in (0, 3) else {1: 6, 2: 3}[s] for s in range(4))


def conversation(rng, id, size):
    texts = ["Yes.", "No", "  \t", "", "What? ", "é.\n", "x" * 40, "Go!", "ok\n\n"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", ""]
    return [(id, rng.choice([None, *range(size)]), rng.choice(roles), rng.choice(texts)) for _ in range(size)]


def report(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def made(spark, rows, tasks=3):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(tasks)


def test_random_conversations(spark):
    rng = random.Random(1)
    rows = [r for id in [None, *range(60)] for r in conversation(rng, id, rng.randrange(1, 9))]
    got = report(cv.repair(made(spark, rows)))
    assert got == {id: want for id, (want, _) in expected(rows).items()}


@pytest.fixture
def many_tasks(spark):
    """Conversations that do not fit a task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_conversation_over_many_tasks(spark, many_tasks):
    rng = random.Random(2)
    long = [(7, k // 2, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(["Yes.", "no", "", f"{k}.", f"{k}"])) for k in range(400)]
    rows = long + [r for id in (3, 9) for r in conversation(rng, id, 5)]
    got = report(cv.repair(made(spark, rows)))
    want = expected(rows)
    assert got == {id: w for id, (w, _) in want.items()}
    turns = cv.repair(made(spark, rows), turns=True).orderBy("conv_id", "number").collect()
    for id, (w, lines) in want.items():
        own = [r for r in turns if r["conv_id"] == id]
        assert [(r["role"], r["text"]) for r in own] == list(lines) and [r["number"] for r in own] == list(range(len(lines)))
        assert "".join(r["edit"] for r in own) == w[6].replace("D", "")


def test_equal_rows_by_number(spark, many_tasks):
    rows = [(1, 0, "user", "Yes."), (1, 1, "assistant", "Fine.")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = report(cv.repair(frame, F.when(F.col("turn") == 1, 5000).otherwise(1)))
    want, _ = brute([rows[0][1:]] + [rows[1][1:]] * 5000)
    assert got[1] == want and got[1][1:4] == (0, 4999, 0)


def test_nothing_left_and_nothing_there(spark):
    frame = spark.createDataFrame([(4, 1, "user", "Yes.", "x", "y"), (5, None, None, None, None, None)], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    got = report(cv.repair(frame, F.when(F.col("conv_id") == 4, 0).otherwise(1)))
    assert got == {4: (0, 0, 0, 0, 0, 0, "", nothing), 5: (0, 1, 0, 0, 0, 4, "D", nothing)}
    assert cv.repair(frame.limit(0)).collect() == []


def test_long_texts(spark):
    rows = [(1, 0, "user", "word " * 300_000 + "."), (1, 1, "assistant", "no end" + " " * 100_000)]
    assert report(cv.repair(made(spark, rows)))[1] == brute([r[1:] for r in rows])[0]


def test_damage_is_by_hash(spark):
    rows = [(i, t, "system", "A. B!") for i in (None, 1, 2, 3) for t in (None, 0, 1, 2, 3, 4, 5, 6)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    changed, copies = cv.damage(frame)
    got = {(r["conv_id"], r["turn"]): (r["role"], r["text"], r["n"]) for r in changed.withColumn("n", copies).collect()}
    for id, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if id is None else id}:{' ' if turn is None else turn}".encode()) % 20
        want = ("user" if fault == 4 else role, "" if fault == 1 else "A B" if fault == 2 else text, {0: 0, 3: 2}.get(fault, 1))
        assert got[id, turn] == want
