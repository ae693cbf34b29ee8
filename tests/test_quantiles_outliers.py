from __future__ import annotations

import math
import random

import pytest
from helpers import rows, unordered

from perennia.operators import outliers, quantiles


def brute(values, prob):
    clean = sorted(v for v in values if v is not None and not (isinstance(v, float) and math.isnan(v)))
    return clean[max(1, math.ceil(round(prob * len(clean), 9))) - 1] if clean else None


@pytest.mark.parametrize("n", [1, 2, 4, 7, 8, 9, 10, 11, 13, 1000])
def test_quantiles_match_sorting(spark, n):
    rng = random.Random(n)
    data = [(rng.randint(-5, 5), rng.gauss(0, 10), rng.choice([None, 1.0, float("nan"), 3.5])) for _ in range(n)]
    frame = spark.createDataFrame(data, "i int, x double, gaps double").repartition(3)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    for column, fitted in zip(zip(*data), quantiles.fit_quantiles(frame, ["i", "x", "gaps"], probs)):
        assert fitted.values == {p: brute(column, p) for p in probs}


@pytest.mark.parametrize("digit", [5, 13, 16])
def test_many_rounds_and_a_hot_value(spark, digit):
    """Digits of every size give the same values."""
    rng = random.Random(1)
    values = [7.25] * 3000 + [rng.lognormvariate(2, 2) for _ in range(6000)]
    whole = [rng.choice([0, 10**15, 10**15 + 1, -3]) for _ in range(9000)]
    data = list(zip(values, whole))
    frame = spark.createDataFrame(data, "x double, w bigint").repartition(4)
    probs = (0.01, 0.25, 0.5, 0.75, 0.999)
    fits = quantiles.fit_quantiles(frame, ["x", "w"], probs, digit=digit)
    for column, fitted in zip((values, whole), fits):
        assert fitted.values == {p: float(brute(column, p)) for p in probs}
        assert fitted.count == 9000 and fitted.minimum == min(column) and fitted.maximum == max(column)


@pytest.mark.parametrize("kind", [int, float])
def test_more_columns_than_a_task_counts_at_once(spark, monkeypatch, kind):
    monkeypatch.setattr(quantiles, "CELLS", 4 << quantiles.DIGIT)
    data = [tuple(kind(i * j) for j in range(9)) for i in range(50)]
    names = [f"c{j}" for j in range(9)]
    fitted = quantiles.fit_quantiles(spark.createDataFrame(data, names), names, (0.5, 1.0))
    assert [f.values for f in fitted] == [{0.5: 24.0 * j, 1.0: 49.0 * j} for j in range(9)]
    assert [f.between for f in fitted] == [0] + [48] * 8


def test_negative_and_wide_whole_numbers(spark):
    data = [(-7 + i % 5, (i - 50) * 10**9, 2**60 + i) for i in range(100)]
    fitted = quantiles.fit_quantiles(spark.createDataFrame(data, "a int, b bigint, c bigint"), ["a", "b", "c"], (0.25, 0.9))
    for column, f in zip(zip(*data), fitted):
        assert f.values == {p: float(brute(column, p)) for p in (0.25, 0.9)}


def test_endless_values_both_zeros_and_the_smallest_numbers(spark):
    inf, tiny = float("inf"), 5e-324
    column = [-inf, -1.5, -tiny, -0.0, 0.0, 0.0, tiny, 1e308, inf, inf, None, float("nan")]
    probs = tuple(k / 20 for k in range(21))
    (fitted,) = quantiles.fit_quantiles(spark.createDataFrame([(v,) for v in column], "x double"), ["x"], probs)
    assert fitted.values == {p: brute(column, p) for p in probs}
    assert (fitted.count, fitted.minimum, fitted.maximum, fitted.between) == (10, -inf, inf, 7)
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert quantiles.fit_quantiles(zeros, ["x"])[0].two_valued


def test_the_number_of_passes_is_fixed(spark, monkeypatch):
    passes = []
    counted = quantiles._digit_counts
    monkeypatch.setattr(quantiles, "_digit_counts", lambda *a: passes.append(a[2]) or counted(*a))
    for column in ([1] * 50, [float(k) for k in range(50)], [k * 1e300 for k in range(50)], [None]):
        passes.clear()
        quantiles.fit_quantiles(spark.createDataFrame([(v,) for v in column], "x int" if column[0] == 1 else "x double"), ["x"])
        assert passes == [52, 39, 26, 13, 0]


def test_no_columns_and_no_rows(spark):
    frame = spark.createDataFrame([], "x double")
    assert quantiles.fit_quantiles(frame, []) == []
    assert quantiles.fit_quantiles(frame, ["x"], (0.5,))[0].values == {0.5: None}


def test_a_column_without_values(spark):
    frame = spark.createDataFrame([(None, 1)], "x double, y int")
    empty, single = quantiles.fit_quantiles(frame, ["x", "y"], (0.5,))
    assert (empty.count, empty.values) == (0, {0.5: None}) and not empty.two_valued
    assert single.values == {0.5: 1.0}


@pytest.fixture(scope="module")
def measured(spark):
    data = [(k, k % 10, 5, float(k), 1 if k % 50 == 0 else 0) for k in range(200)]
    data += [(200, 500, 5, 1e6, 0), (201, None, 5, float("nan"), 1), (202, -500, 6, None, None)]
    return spark.createDataFrame(data, "key int, a int, const int, c double, flag int")


def test_bounds_and_counts(measured):
    cols = outliers.outlier_columns(measured, exclude=["key"])
    assert cols == ["a", "const", "c", "flag"]
    bounds = outliers.outlier_bounds(measured, cols)
    by_name = {r.column_name: r for r in bounds.collect()}
    assert (by_name["a"].q1, by_name["a"].q3) == (2.0, 7.0)
    assert (by_name["a"].lower_bound, by_name["a"].upper_bound) == (-5.5, 14.5)
    assert by_name["flag"].two_valued and by_name["const"].two_valued and not by_name["a"].two_valued
    counted = outliers.outlier_count(measured, bounds)
    totals = {r.key: r.total_outliers for r in counted.collect()}
    assert (totals[200], totals[201], totals[202]) == (2, 0, 1)
    assert sum(totals.values()) == 3
    assert unordered(outliers.outlier_distribution(counted)) == [(0, 201), (1, 1), (2, 1)]
    kept = outliers.drop_outlier_rows(measured, bounds, max_flags=1)
    assert kept.count() == 202 and kept.columns == measured.columns


def test_int_columns_with_flags(measured):
    cols = outliers.outlier_columns(measured, exclude=["key"], ints_only=True)
    assert cols == ["a", "const", "flag"]
    counted = outliers.outlier_count(measured, outliers.outlier_bounds(measured, cols), skip_two_valued=False)
    # The rarer value of a flag lies outside an empty range.
    assert counted.filter("flag = 1 and total_outliers = 1").count() == 5
    assert [r for r in rows(counted.filter("key = 202").select("total_outliers"))] == [(2,)]


def test_count_is_the_sum_of_single_columns(measured):
    cols = ["a", "const", "c", "flag"]
    bounds = outliers.outlier_bounds(measured, cols)
    whole = {r.key: r.total_outliers for r in outliers.outlier_count(measured, bounds).collect()}
    parts = dict.fromkeys(whole, 0)
    for c in cols:
        one = outliers.outlier_count(measured, bounds.filter(bounds.column_name == c))
        for r in one.collect():
            parts[r.key] += r.total_outliers
    assert whole == parts
