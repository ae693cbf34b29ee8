from __future__ import annotations

import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from perennia.operators import ranking


@pytest.fixture(scope="module")
def counted(spark):
    """A hot group with most of the rows and many ties, small groups, a null group."""
    rng = random.Random(5)
    data = [("hot", f"v{i:04d}", rng.randint(1, 6)) for i in range(1500)]
    data += [(f"g{i % 40}", f"v{i:04d}", rng.randint(1, 9)) for i in range(400)]
    data += [(None, f"v{i}", i % 3) for i in range(7)]
    return spark.createDataFrame(data, "g string, v string, n int").repartition(5), data


def expected_ranks(data, descending=True):
    out = set()
    for group in {g for g, _, _ in data}:
        inside = sorted(((-n if descending else n), v) for g, v, n in data if g == group)
        out |= {(group, v, abs(n), i) for i, (n, v) in enumerate(inside, 1)}
    return out


@pytest.mark.parametrize("descending", [True, False])
def test_rank_in_group_numbers_every_row(counted, descending):
    frame, data = counted
    ranked = ranking.rank_in_group(frame, ["g"], "n", ["v"], descending=descending)
    assert ranked.columns == ["g", "v", "n", "rank"]
    got = rows(ranked)
    assert len(got) == len(data)
    assert set(got) == expected_ranks(data, descending)


def test_hot_group_is_cut_into_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(4000).select(F.lit("hot").alias("g"), "id", (F.col("id") % 2).alias("n"))
        ranked = ranking.rank_in_group(frame, ["g"], "n", ["id"])
        assert {r["rank"] for r in ranked.select("rank").collect()} == set(range(1, 4001))
        text = plan(ranked)
        assert "_slice" in text
        # The rows' window is partitioned by slice, never by the group alone.
        assert "windowspecdefinition(g#" in text and "_slice" in text.split("row_number()")[1][:80]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_top_k_per_group_cut(counted):
    frame, data = counted
    got = ranking.top_k_per_group(frame, ["g"], 3, "n", ["v"], rank_name="rank")
    assert set(rows(got)) == {r for r in expected_ranks(data) if r[3] <= 3}
    assert plan(got).count("WindowGroupLimit") >= 2


def test_top_k_per_group_beyond_the_window_limit(spark, counted):
    frame, data = counted
    got = ranking.top_k_per_group(frame, ["g"], 1200, "n", ["v"], rank_name="rank")
    assert set(rows(got)) == {r for r in expected_ranks(data) if r[3] <= 1200}


def test_top_k_per_group_keeps_ties(counted):
    frame, data = counted
    got = set(rows(ranking.top_k_per_group(frame, ["g"], 2, "n", ["v"], ties="keep")))
    want = set()
    for group in {g for g, _, _ in data}:
        values = sorted((n for g, _, n in data if g == group), reverse=True)
        bound = values[min(2, len(values)) - 1]
        want |= {(g, v, n) for g, v, n in data if g == group and n >= bound}
    assert got == want


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("k", [0, 1, 4, 100])
def test_top_k_ties(spark, k, descending):
    data = [("a", 3), ("b", 1), ("c", 3), ("d", 2), ("e", 1), ("f", None), ("g", 2), ("h", 2)]
    frame = spark.createDataFrame(data, "name string, n int")
    present = [d for d in data if d[1] is not None]
    ordered = sorted(present, key=lambda d: (-d[1] if descending else d[1], d[0]))
    cut = ranking.top_k(frame.filter("n is not null"), k, "n", ["name"], descending=descending)
    assert rows(cut) == ordered[:k]
    kept = ranking.top_k(frame, k, "n", ["name"], descending=descending, ties="keep")
    if k == 0:
        assert rows(kept) == []
    else:
        bound = ordered[min(k, len(ordered)) - 1][1]
        assert rows(kept) == [d for d in ordered if (d[1] >= bound if descending else d[1] <= bound)]


def test_ties_bound_is_a_subquery_without_a_cross_join(spark):
    counts = spark.range(1000).groupBy((F.col("id") % 50).alias("g")).agg(F.count("*").alias("n"))
    top = ranking.top_k(counts, 5, "n", ["g"], ties="keep")
    assert top.count() == 50
    text = plan(top)
    assert "Subquery" in text and "Cartesian" not in text and "NestedLoop" not in text


def test_empty_input(spark):
    empty = spark.createDataFrame([], "g string, n int")
    assert rows(ranking.top_k(empty, 3, "n", ["g"], ties="keep")) == []
    assert rows(ranking.rank_in_group(empty, ["g"], "n", ["n"])) == []


def test_bad_arguments(spark):
    frame = spark.createDataFrame([("a", 1)], "g string, n int")
    for call in (
        lambda: ranking.top_k(frame, -1, "n", ["g"]),
        lambda: ranking.top_k(frame, 1, "n", ["g"], ties="maybe"),
        lambda: ranking.top_k_per_group(frame, ["g"], 1, "n", ["g"], ties="maybe"),
        lambda: ranking.top_k_per_group(frame, ["g"], 1, "n", ["g"], ties="keep", rank_name="r"),
    ):
        with pytest.raises(ValueError):
            call()


