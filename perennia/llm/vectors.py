"""What the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, empty or zero, and all its components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def in_blocks(rows: DataFrame, blocks: Column, key: str) -> DataFrame:
    """Every row of a group in ``blocks`` blocks, once for each block that its own one meets: columns own and other."""
    own = F.pmod(F.xxhash64(key), blocks).cast("int")
    dealt = rows.withColumn("own", own)
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
