"""Casts that give null instead of an error, and coded values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions.columns import field, is_floating, is_integral, is_text

# A failing try_cast of text costs an exception per row, so text that is no value of the
# target type is sorted out by its whole shape first.
_WHOLE = r"^\s*([+-]?[0-9]+)(?:\.[0-9]*)?\s*$"
_NUMBER = (
    r"^[\x00-\x20]*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[dDfF]?"
    r"|0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[dDfF]?"
    r"|(?i:inf|infinity|nan))[\x00-\x20]*$"
)
_SHORTEST_DATE = len("2000-1-1")


def text_to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def text_to_whole(text: Column, target: T.DataType | str = "int") -> Column:
    """Whole numbers, and the part before the point of decimal texts."""
    digits = F.regexp_extract(text, _WHOLE, 1)
    return F.when(digits != "", digits.try_cast(target))


def text_to_date(text: Column, pattern: str | None = None) -> Column:
    """Dates written year-month-day, or in a datetime pattern; null for other texts."""
    if pattern is not None:
        return F.to_date(F.try_to_timestamp(text, F.lit(pattern)))
    return F.when(F.length(F.trim(text)) >= _SHORTEST_DATE, text.try_cast("date"))


def safe_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """The value in the target type, or null where it is none."""
    if is_text(source):
        if isinstance(target, T.DateType):
            return text_to_date(column)
        if is_integral(target):
            return text_to_whole(column, target)
        if is_floating(target):
            return text_to_double(column).try_cast(target)
    return column.try_cast(target)


def to_int(df: DataFrame, name: str) -> Column:
    """The column truncated to int; null where it does not fit or is not a number."""
    return safe_cast(field(name), df.schema[name].dataType, T.IntegerType())


def encode_map(column: Column, codes: Mapping[object, int]) -> Column:
    """Integer code per listed value, null for every other value."""
    chain = None
    for value, code in codes.items():
        chain = F.when(column == value, code) if chain is None else chain.when(column == value, code)
    if chain is None:
        raise ValueError("encode_map needs at least one value")
    return chain.cast("int")


def year_at_most(df: DataFrame, name: str, year: int) -> Column:
    """``year(name) <= year`` written as a range on the column itself.

    A typed date or timestamp column keeps its bare form, so the test reaches the
    scan; ``year(col) <= n`` would not.
    """
    dtype = df.schema[name].dataType
    first_day_after = F.lit(f"{year + 1:04d}-01-01")
    if is_text(dtype):
        return text_to_date(field(name)) < first_day_after.cast("date")
    return field(name) < first_day_after.cast(dtype)
