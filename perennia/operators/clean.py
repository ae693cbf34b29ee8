"""Repairs over lists of columns; each is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions import encode_map, field, present_double, rating, safe_cast, to_int


def column_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Means of the present values, in one job; pass them to ``impute_mean`` to fit once."""
    row = df.agg(*[F.avg(present_double(df, c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return dict(zip(cols, row))


def impute_mean(df: DataFrame, cols: Sequence[str], means: Mapping[str, float | None] | None = None) -> DataFrame:
    """Missing values become the column's mean; the columns become doubles.

    Without fitted ``means`` the result stays lazy: all means are one scalar subquery.
    """
    if means is None:
        fitted = df.agg(
            F.struct(*[F.avg(present_double(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
        ).scalar()
        fill = {c: fitted.getField(f"m{i}") for i, c in enumerate(cols)}
    else:
        fill = {c: F.lit(means[c]).cast("double") for c in cols}
    return df.withColumns({c: F.coalesce(present_double(df, c), fill[c]) for c in cols})


def parse_ratings(df: DataFrame, cols: Sequence[str], mode: str = "base") -> DataFrame:
    return df.withColumns({c: rating(field(c).cast("string"), mode) for c in cols})


def encode_columns(df: DataFrame, codes: Mapping[str, Mapping[object, int]]) -> DataFrame:
    """Replace coded columns: ``{"gender": {"M": 1, "F": 0}}``."""
    return df.withColumns({c: encode_map(field(c), mapping) for c, mapping in codes.items()})


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Replace columns by their safe casts."""
    parsed = {c: T.DataType.fromDDL(t) if isinstance(t, str) else t for c, t in types.items()}
    return df.withColumns({c: safe_cast(field(c), df.schema[c].dataType, t) for c, t in parsed.items()})


def truncate_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_int(df, c) for c in cols})
