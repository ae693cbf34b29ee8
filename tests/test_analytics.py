from __future__ import annotations

import pytest
from helpers import plan, rows, unordered
from pyspark.sql import functions as F

from perennia.operators import analytics

CONTRACTS = (
    "sofifa_id int, long_name string, club_name string, club_joined string, "
    "club_contract_valid_until string, year int, gender string"
)


@pytest.fixture(scope="module")
def contracts(spark):
    data = [
        # changed club: counts once, for the newest qualifying snapshot
        (1, "Ada", "Old", "2014-07-01", "2024", 2015, "M"),
        (1, "Ada", "New", "2016-07-01", "2025", 2017, "M"),
        (2, "Bo", "New", "2015-01-01", "2023", 2016, "M"),
        (3, "Cy", "Old", "2017-12-31", "2023", 2018, "M"),
        (4, "Di", "Old", "2018-01-01", "2030", 2018, "M"),  # joined after
        (5, "Ed", "Old", "2012-01-01", "2022", 2016, "M"),  # contract too short
        (6, "Fe", None, "2012-01-01", "2026", 2016, "M"),
        (7, "Gu", "Third", "2011-01-01", "2026", 2016, "M"),
        (8, "Hy", "Old", "2010-01-01", "NA", 2016, "M"),  # unknown contract
        (9, "Io", "Old", "someday", "2029", 2016, "M"),  # unknown date
        (10, "Jo", "Old", "2010-01-01", "2029.0", 2016, "F"),
    ]
    return spark.createDataFrame(data, CONTRACTS)


def ask(frame, **options):
    return analytics.top_groups_by_contract(
        frame.filter("gender = 'M'"),
        2017,
        options.pop("limit", 5),
        2023,
        entity=["sofifa_id", "long_name"],
        group="club_name",
        joined="club_joined",
        until="club_contract_valid_until",
        period="year",
        **options,
    )


def test_contract_groups(contracts):
    assert rows(ask(contracts)) == [("New", 2), (None, 1), ("Old", 1), ("Third", 1)]


def test_contract_groups_cut_ties_and_nulls(contracts):
    assert rows(ask(contracts, limit=2)) == [("New", 2), (None, 1)]
    assert rows(ask(contracts, limit=2, ties="keep")) == [("New", 2), (None, 1), ("Old", 1), ("Third", 1)]
    assert rows(ask(contracts, limit=2, drop_null_groups=True)) == [("New", 2), ("Old", 1)]


def test_contract_date_range_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/c"
    spark.createDataFrame([(1, "a", 5, 1)], "id int, g string, until int, year int").withColumn(
        "joined", F.lit("2015-05-05").cast("date")
    ).write.parquet(path)
    top = analytics.top_groups_by_contract(
        spark.read.parquet(path), 2017, 3, 5, entity=["id"], group="g", joined="joined", until="until", period="year"
    )
    assert rows(top) == [("a", 1)]
    text = plan(top)
    assert "LessThan(joined,2018-01-01)" in text and "GreaterThanOrEqual(until,5)" in text


AGES = [
    ("A", 30, 2017), ("A", 20, 2017), ("B", 25, 2017), ("C", 28, 2017), ("D", 21, 2017), ("D", 21, 2017),
    ("E", None, 2017), (None, 24, 2017), ("A", 99, 2016),
]


@pytest.fixture(scope="module")
def ages(spark):
    return spark.createDataFrame(AGES, "club string, age int, year int")


def extreme(frame, k, **options):
    return analytics.extreme_groups_by_avg(frame, k, group="club", measure="age", **options)


def test_extreme_averages_keep_ties(ages):
    frame = ages.filter("year = 2017")
    assert rows(extreme(frame, 2)) == [("C", 28.0), ("A", 25.0), ("B", 25.0)]
    assert rows(extreme(frame, 2, highest=False)) == [("D", 21.0), (None, 24.0)]
    assert rows(extreme(frame, -2)) == rows(extreme(frame, 2, highest=False))
    assert rows(extreme(frame, 2, highest=False, drop_null_groups=True)) == [("D", 21.0), ("A", 25.0), ("B", 25.0)]
    assert len(rows(extreme(frame, 100))) == 5  # E has no known age


def test_extreme_averages_of_nothing(ages):
    assert rows(extreme(ages.filter("year = 1900"), 3)) == []
    assert rows(extreme(ages.filter("year = 2017"), 0)) == []


def test_tied_floating_averages_do_not_depend_on_row_order(spark):
    # The same values in another order per group; a double sum would differ in its last bit.
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 0.7]
    data = [(g, v) for g in range(6) for v in (values[g:] + values[:g])]
    frame = spark.createDataFrame(data, "club int, age double").repartition(4)
    assert len(rows(extreme(frame, 1))) == 6


def test_dedup_keeps_one_whole_row(spark):
    data = [(1, 2015, "x", 9), (1, 2016, "b", 1), (1, 2016, "a", 2), (2, None, "n", 0), (2, 2014, "m", 5), (None, 1, "z", 1)]
    frame = spark.createDataFrame(data, "k int, year int, s string, v int").repartition(3)
    assert unordered(analytics.dedup_latest(frame, ["k"], "year")) == [
        (1, 2016, "a", 2),
        (2, 2014, "m", 5),
        (None, 1, "z", 1),
    ]
    earliest = analytics.dedup_latest(frame, ["k"], "year", keep="earliest")
    assert (1, 2015, "x", 9) in rows(earliest)
    assert plan(earliest).count("WindowGroupLimit") >= 2
    with pytest.raises(ValueError):
        analytics.dedup_latest(frame, ["k"], "year", keep="any")


def test_mode_per_group(spark):
    data = [(2020, "X")] * 3 + [(2020, "Y")] * 3 + [(2020, "Z")] + [(2021, None)] * 2 + [(2021, "Y")]
    frame = spark.createDataFrame(data, "year int, nation string")
    assert unordered(analytics.mode_per_group(frame, "year", "nation")) == [(2020, "X", 3), (2021, None, 2)]
    kept = analytics.mode_per_group(frame, "year", "nation", ties="keep")
    assert unordered(kept) == [(2020, "X", 3), (2020, "Y", 3), (2021, None, 2)]
    top = analytics.top_values_per_group(frame, "year", "nation", 2)
    assert unordered(top) == [(2020, "X", 3, 1), (2020, "Y", 3, 2), (2021, "Y", 1, 2), (2021, None, 2, 1)]
    assert len(rows(analytics.rank_values_in_group(frame, "year", "nation"))) == 5


def test_grouped_counts_and_means(spark):
    frame = spark.createDataFrame([("a", 1.5), ("a", float("nan")), ("a", 2.5), ("b", None)], "g string, v double")
    assert unordered(analytics.group_count(frame, "g")) == [("a", 3), ("b", 1)]
    assert unordered(analytics.group_avg(frame, ["g"], "v")) == [("a", 2.0), ("b", None)]


def test_extreme_averages_of_floating_and_text_measures(spark):
    rows_ = [("a", 1e-13), ("b", 4e-13), ("c", 2e-13), ("d", float("inf")), ("e", 1e27), ("f", None), ("g", float("nan"))]
    frame = spark.createDataFrame(rows_, "g string, v double")
    top = analytics.extreme_groups_by_avg(frame, 1, group="g", measure="v")
    assert [tuple(r) for r in top.collect()] == [("d", float("inf"))]
    low = analytics.extreme_groups_by_avg(frame, -1, group="g", measure="v")
    assert [tuple(r) for r in low.collect()] == [("a", 1e-13)]
    texts = spark.createDataFrame([("a", "1.5"), ("a", "NA"), ("b", "0.5"), ("c", "x")], "g string, v string")
    assert [tuple(r) for r in analytics.extreme_groups_by_avg(texts, 1, group="g", measure="v").collect()] == [("a", 1.5)]


def test_intervals_keep_every_group_that_ties_exactly(spark):
    """Sums whose last bits depend on the order: the groups of equal exact means are all found, and no other."""
    values = [1e16, 1.0, -1e16, 3.0, 1e-3, 2.0**-60]
    data = [(g, v) for g in range(5) for v in values[g:] + values[:g]] + [(9, v) for v in values[:-1]]
    data += [(20, float("inf")), (21, float("-inf")), (22, float("inf")), (22, float("-inf")), (23, None), (24, float("nan"))]
    frame = spark.createDataFrame(data, "club int, age double").repartition(5)
    finite = frame.filter("club < 20")
    assert sorted(r.club for r in extreme(finite, -1).collect()) == [0, 1, 2, 3, 4]
    assert [r.club for r in extreme(finite, 1).collect()] == [9]
    assert {r.club for r in extreme(frame, 2).collect()} >= {20}
    assert extreme(frame, -1).collect()[0].club == 21
    large = spark.createDataFrame([(1, 2**62), (1, 2**62), (1, 2**62 + 2), (2, 2**62), (2, 2**62)], "club int, age bigint")
    assert [tuple(r)[0] for r in extreme(large, 1).collect()] in ([1], [1, 2])  # a double of the exact sum over the number
