from __future__ import annotations

import math

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from perennia.functions import encode_map, rating, text_to_double, to_int
from perennia.functions.casts import text_to_date
from perennia.operators import clean, quality


@pytest.fixture(scope="module")
def dirty(spark):
    nan = float("nan")
    return spark.createDataFrame(
        [(1, 1, 1.0, "70", "NA"), (2, None, nan, "NA", None), (3, 3, None, "abc", "NA"), (4, None, 4.0, None, "x")],
        "key int, i int, d double, s string, t string",
    ).withColumn("a.b", F.lit("NA"))


def test_missing_depends_on_the_type(dirty):
    assert dict(rows(quality.missing_counts(dirty))) == {"key": 0, "i": 2, "d": 2, "s": 2, "t": 3, "a.b": 4}
    ratios = {r.column_name: (r.total, r.ratio) for r in quality.missing_ratio(dirty).collect()}
    assert ratios["t"] == (4, 0.75) and ratios["i"] == (4, 0.5)


def test_sparse_columns_strictly_above_the_threshold(dirty):
    assert {r.column_name for r in quality.sparse_columns(dirty).collect()} == {"t", "a.b"}
    assert quality.drop_sparse(dirty).columns == ["key", "i", "d", "s"]


def test_missing_ratio_of_an_empty_table(dirty):
    assert {r.ratio for r in quality.missing_ratio(dirty.limit(0)).collect()} == {None}
    assert quality.drop_sparse(dirty.limit(0)).columns == dirty.columns


def test_profile_is_one_pass(dirty):
    frame = quality.missing_ratio(dirty)
    assert plan(frame).count("Exchange SinglePartition") <= 1


def test_non_numeric_counts(spark, dirty):
    frame = dirty.withColumn("day", F.lit("2020-01-01").cast("date"))
    got = dict(rows(quality.non_numeric_counts(frame)))
    assert got == {"key": 0, "i": 0, "d": 0, "s": 2, "t": 3, "a.b": 4, "day": 4}


def test_select_by_type_and_prefix(dirty):
    assert quality.select_by_type(dirty, ["int", "double"]).columns == ["key", "i", "d"]
    assert quality.drop_by_prefix(dirty, "a.").columns == ["key", "i", "d", "s", "t"]


def test_impute_fills_everything_counted_as_missing(dirty):
    filled = clean.impute_mean(dirty, ["i", "d", "s"])
    assert [tuple(r) for r in filled.orderBy("key").select("i", "d", "s").collect()] == [
        (1.0, 1.0, 70.0),
        (2.0, 2.5, 70.0),
        (3.0, 2.5, 70.0),
        (2.0, 4.0, 70.0),
    ]
    assert "Subquery" in plan(filled) and "Join" not in plan(filled)
    means = clean.column_means(dirty, ["i", "d"])
    assert means == {"i": 2.0, "d": 2.5}
    again = clean.impute_mean(dirty, ["i", "d"], means)
    assert rows(again.orderBy("key").select("i", "d")) == rows(filled.orderBy("key").select("i", "d"))
    assert "Subquery" not in plan(again)


def test_impute_a_column_without_values(dirty):
    assert {r[0] for r in rows(clean.impute_mean(dirty, ["a.b"]).select("`a.b`"))} == {None}


RATINGS = {
    "79+3": (79, 82),
    "60-2": (60, 58),
    "55": (55, 55),
    " 55 ": (55, 55),
    "79.5": (79, None),
    "NA": (None, None),
    "": (None, None),
    "+5": (None, None),
    "7x+3": (7, None),
    "abc": (None, None),
    None: (None, None),
}


def test_ratings(spark):
    frame = spark.createDataFrame([(text,) for text in RATINGS], "st string")
    got = frame.select("st", rating(F.col("st")), rating(F.col("st"), "sum"))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == RATINGS
    assert [r.st for r in clean.parse_ratings(frame, ["st"]).collect()] == [base for base, _ in RATINGS.values()]
    with pytest.raises(ValueError):
        rating(F.col("st"), "other")


def test_codes_and_casts(spark):
    frame = spark.createDataFrame([("Right",), ("Left",), ("Both",), (None,)], "foot string")
    coded = frame.select(encode_map(F.col("foot"), {"Right": 1, "Left": 0}))
    assert [r[0] for r in coded.collect()] == [1, 0, None, None]
    assert coded.dtypes[0][1] == "int"
    with pytest.raises(ValueError):
        encode_map(F.col("foot"), {})
    numbers = spark.createDataFrame([(58.9,), (-58.9,), (1e30,), (float("nan"),), (None,)], "d double")
    assert [r[0] for r in numbers.select(to_int(numbers, "d")).collect()] == [58, -58, None, None, None]
    wholes = spark.createDataFrame([("7",), (" 7.9 ",), ("-3.",), ("1e3",), ("99999999999",), ("NA",), ("",)], "s string")
    assert [r[0] for r in wholes.select(to_int(wholes, "s")).collect()] == [7, 7, -3, None, None, None, None]
    doubles = spark.createDataFrame([("1e3",), (" .5",), ("NaN",), ("-inf",), ("NA",), ("x",), ("2+1",)], "s string")
    got = [r[0] for r in doubles.select(text_to_double(F.col("s"))).collect()]
    assert got[:2] == [1000.0, 0.5] and math.isnan(got[2]) and got[3:] == [-math.inf, None, None, None]
    texts = spark.createDataFrame([("12", "1.5", "2020-02-30"), ("NA", "x", "2020-02-29")], "i string, d string, t string")
    cast = clean.cast_columns(texts, {"i": "int", "d": "double", "t": "date"}).withColumn("t", F.col("t").cast("string"))
    assert rows(cast) == [(12, 1.5, None), (None, None, "2020-02-29")]
    encoded = clean.encode_columns(frame, {"foot": {"Right": 1, "Left": 0}})
    assert [r.foot for r in encoded.collect()] == [1, 0, None, None]


NUMBERS = """1 -1 +1 1.5 .5 5. 1e3 1E-3 1.e2 1d 1.5f 0x1p3 0x.8p1 inf -inf Infinity nan NaN 007 1_000 1,5 79+3 60-2
1996-01-02 1.2.3 . - + e5 1e 0x12 12a a12 infinit nano NA 1e400 --1 +-1 0xp1 1D2 ٣""".split()


def test_text_that_is_a_number(spark):
    texts = [*NUMBERS, "", " ", " 1 ", "\t2\n", "1 2", "- 1", "\x003"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select("t", text_to_double(F.col("t")).alias("a"), F.col("t").try_cast("double").alias("b")).collect()
    assert [(r.t, r.a) for r in got if str(r.a) != str(r.b)] == []


def test_date_patterns(spark):
    frame = spark.createDataFrame([("31/01/2020",), ("2020-01-31",), ("x",), (None,)], "t string")
    got = frame.select(text_to_date(F.col("t"), "dd/MM/yyyy").cast("string").alias("d")).collect()
    assert [r.d for r in got] == ["2020-01-31", None, None, None]
