"""Missing values, non-numeric values and sparse columns: one aggregate for all columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions import field, is_numeric, is_text, missing, text_to_double
from perennia.sources.schema import one_row_per_column


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, missing)"""
    return one_row_per_column(df, {c: F.count_if(missing(df, c)) for c in cols or df.columns}, "missing")


def missing_ratio(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, missing, total, ratio); the ratio of an empty table is null."""
    counts = {c: F.count_if(missing(df, c)) for c in cols or df.columns}
    per_column = one_row_per_column(df, counts, "missing", shared={"total": F.count("*")})
    return per_column.withColumn("ratio", F.try_divide(F.col("missing"), F.col("total")))


def sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``missing_ratio`` above the threshold; a column exactly at it is not sparse."""
    return missing_ratio(df).filter(F.col("ratio") > threshold)


def drop_sparse(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The table without its sparse columns.  Runs one job, because the schema depends on it."""
    names = [row.column_name for row in sparse_columns(df, threshold).select("column_name").collect()]
    return df.select(*[field(c) for c in df.columns if c not in names])


def non_numeric_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, non_numeric): present values that are not numbers."""

    def test(name: str):
        dtype = df.schema[name].dataType
        value = field(name)
        if is_numeric(dtype) or isinstance(dtype, T.BooleanType):
            return F.lit(False)
        if is_text(dtype):
            return value.isNotNull() & text_to_double(value).isNull()
        return value.isNotNull()

    return one_row_per_column(df, {c: F.count_if(test(c)) for c in cols or df.columns}, "non_numeric")


def select_by_type(df: DataFrame, types: Sequence[str]) -> DataFrame:
    """The columns of the given types, written as in ``df.dtypes``."""
    return df.select(*[field(name) for name, dtype in df.dtypes if dtype in types])


def drop_by_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[field(c) for c in df.columns if not c.startswith(prefix)])
