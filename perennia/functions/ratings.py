"""Rating texts such as ``79+3`` or ``60-2``: a base and an optional signed change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading digits, then either the end (a fraction is cut off) or a sign somewhere after.
_BASE = r"^\s*([0-9]+)(?:(?:\.[0-9]*)?\s*$|.*[+-])"
_BASE_AND_CHANGE = r"^\s*([0-9]+)([+-][0-9]+)?\s*$"


def rating(column: Column, mode: str = "base") -> Column:
    """``base`` keeps the number before the sign, ``sum`` adds the signed change to it."""
    if mode == "base":
        return _whole(F.regexp_extract(column, _BASE, 1))
    if mode == "sum":
        base = _whole(F.regexp_extract(column, _BASE_AND_CHANGE, 1))
        change = _whole(F.regexp_extract(column, _BASE_AND_CHANGE, 2))
        return base + F.coalesce(change, F.lit(0))
    raise ValueError(f"unknown rating mode {mode!r}")


def _whole(digits: Column) -> Column:
    return F.when(digits != "", digits.try_cast("int"))
