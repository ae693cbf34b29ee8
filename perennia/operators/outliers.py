"""Interquartile-range outliers: bounds per column, flags per row, rows to keep."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.functions import field, is_floating, is_numeric
from perennia.operators.analytics import group_count
from perennia.operators.quantiles import fit_quantiles
from perennia.sources.schema import small_table

BOUNDS_DDL = (
    "column_name string, n bigint, minimum double, q1 double, q3 double, maximum double, "
    "lower_bound double, upper_bound double, two_valued boolean"
)


def outlier_columns(df: DataFrame, exclude: Sequence[str] = (), ints_only: bool = False) -> list[str]:
    """Numeric columns to test: all but ``exclude`` (label, keys), or just the ints."""
    if ints_only:
        return [name for name, dtype in df.dtypes if dtype == "int" and name not in exclude]
    return [f.name for f in df.schema if is_numeric(f.dataType) and f.name not in exclude]


def outlier_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5, **options) -> DataFrame:
    """Exact quartiles and ``q1 - k * iqr`` / ``q3 + k * iqr`` per column, fitted in five passes.

    The result is a small table that can be stored and used on other rows.
    """
    rows = []
    for fitted in fit_quantiles(df, cols, (0.25, 0.75), **options):
        q1, q3 = fitted.values[0.25], fitted.values[0.75]
        reach = None if q1 is None else k * (q3 - q1)
        rows.append(
            {
                "column_name": fitted.name,
                "n": fitted.count,
                "minimum": fitted.minimum,
                "q1": q1,
                "q3": q3,
                "maximum": fitted.maximum,
                "lower_bound": None if q1 is None else q1 - reach,
                "upper_bound": None if q1 is None else q3 + reach,
                "two_valued": fitted.two_valued,
            }
        )
    return small_table(df.sparkSession, rows, BOUNDS_DDL)


def outlier_flags(df: DataFrame, bounds: DataFrame, skip_two_valued: bool = True) -> dict[str, Column]:
    """A 0/1 column per bounded column; missing values are no outliers.

    A column with two values at most (a 0/1 flag) is left out, since its rarer value
    would always lie outside an empty range; ``skip_two_valued=False`` tests it too.
    """
    flags = {}
    for row in bounds.select("column_name", "lower_bound", "upper_bound", "two_valued").collect():
        if row.lower_bound is None or (skip_two_valued and row.two_valued):
            continue
        value = field(row.column_name)
        outside = (value < F.lit(row.lower_bound)) | (value > F.lit(row.upper_bound))
        if is_floating(df.schema[row.column_name].dataType):
            outside = outside & ~F.isnan(value)
        flags[row.column_name] = F.when(outside, 1).otherwise(0)
    return flags


def outlier_count(
    df: DataFrame, bounds: DataFrame, name: str = "total_outliers", skip_two_valued: bool = True
) -> DataFrame:
    """Rows with the number of their values outside the bounds: one projection, no shuffle."""
    flags = outlier_flags(df, bounds, skip_two_valued)
    return df.withColumn(name, reduce(add, flags.values(), F.lit(0)))


def drop_outlier_rows(
    df: DataFrame, bounds: DataFrame, max_flags: int = 10, skip_two_valued: bool = True
) -> DataFrame:
    """Rows with at most ``max_flags`` values outside the bounds."""
    flags = outlier_flags(df, bounds, skip_two_valued)
    return df.filter(reduce(add, flags.values(), F.lit(0)) <= max_flags)


def outlier_distribution(counted: DataFrame, name: str = "total_outliers") -> DataFrame:
    """Rows per number of outliers."""
    return group_count(counted, name)
