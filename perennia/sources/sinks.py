"""Writers (always from the executors) and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.functions import missing
from perennia.sources.schema import one_row_per_column


def _by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    # Gathers each output partition's rows, and lets AQE split the ones that are too large.
    return df.hint("rebalance", *[F.col(name) for name in partition_by]) if partition_by else df


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """A directory of CSV parts with a header each; nothing passes through the driver."""
    writer = _by_partition(df, partition_by).write.mode(mode).option("header", True)
    writer.partitionBy(*partition_by).csv(path)


def write_snapshots(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("year", "gender"), mode: str = "overwrite"
) -> None:
    """Parquet by period, so that questions about one year read only that year."""
    _by_partition(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 20) -> DataFrame:
    """The first n rows of a total order: each task keeps n rows, and only those are merged."""
    return df.orderBy(*order_by).limit(n)


def schema_profile(df: DataFrame, counts: bool = False) -> DataFrame:
    """(column_name, data_type, nullable, position) for every column, without reading the table.

    With ``counts`` also the number of missing values, in one pass.
    """
    if not counts:
        rows = [(f.name, f.dataType.simpleString(), f.nullable, k) for k, f in enumerate(df.schema, 1)]
        return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, nullable boolean, position int")
    described = {
        f.name: {
            "data_type": F.lit(f.dataType.simpleString()),
            "nullable": F.lit(f.nullable),
            "position": F.lit(position),
        }
        for position, f in enumerate(df.schema, 1)
    }
    found = {name: F.count_if(missing(df, name)) for name in df.columns}
    return one_row_per_column(df, found, "missing", labels=described)
