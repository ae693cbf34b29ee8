"""Relational databases through Spark's JDBC source.

A plain JDBC read is one task.  Given a numeric, date or timestamp column and its
bounds, the read is split into ranges; rows outside the bounds still arrive, in the
first and last range.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    split = (column, lower, upper, partitions)
    if any(part is not None for part in split) and any(part is None for part in split):
        raise ValueError("a split read needs column, lower, upper and partitions together")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **dict(properties or {})}
    if column is not None:
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None, **split) -> DataFrame:
    """The table as a lazy scan; equality and range filters and column choice reach the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **split)).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    connections: int = 16,
    column_types: str | None = None,
) -> None:
    """Parallel insert over at most ``connections`` connections.

    Overwriting empties the table and keeps its declared types instead of dropping it.
    """
    writer = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .option("truncate", True)
        .options(**dict(properties or {}))
    )
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.mode(mode).save()
