"""What counts as a missing value, decided by the column's type.

Text is missing when null or the marker ``NA``; floating point when null or NaN;
everything else when null.  Comparing a typed column with the marker would raise
under ANSI, so the test is always built from the schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions.casts import safe_cast
from perennia.functions.columns import field, is_floating, is_text

MISSING_TEXT = "NA"


def missing(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    value = field(name)
    if is_text(dtype):
        return value.isNull() | (value == MISSING_TEXT)
    if is_floating(dtype):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def present_double(df: DataFrame, name: str) -> Column:
    """The value as a double, null where it is missing or not a number."""
    value = safe_cast(field(name), df.schema[name].dataType, T.DoubleType())
    return F.when(~missing(df, name) & ~F.isnan(value), value)
