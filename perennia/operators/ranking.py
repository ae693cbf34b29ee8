"""Top-k with or without ties, and full ranks, without a task that holds a whole group.

Inputs are grouped tables (one row per group value), so the rows of a hot key have
already been combined before anything here shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perennia.functions import field
from perennia.sources.scratch import materialise


def _order(by: str, descending: bool) -> Column:
    return field(by).desc_nulls_last() if descending else field(by).asc_nulls_last()


def _at_or_beyond(by: str, bound: Column, descending: bool) -> Column:
    return field(by) >= bound if descending else field(by) <= bound


def _last(by: str, descending: bool) -> Column:
    return F.min(field(by)) if descending else F.max(field(by))


def top_k(
    df: DataFrame, k: int, by: str, tie_break: Sequence[str], *, descending: bool = True, ties: str = "cut"
) -> DataFrame:
    """The k best rows by ``by``.

    ``cut``: exactly k, equal values in the order of ``tie_break``.  ``keep``: every row
    that reaches the k-th best value; that value is a scalar subquery over the same
    grouped rows (the shuffle is reused), and the comparison runs in parallel however
    many rows are tied.  Rows without a value are never among the best; k = 0 is empty.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    ranked = df.filter(field(by).isNotNull()) if ties == "keep" else df
    best = ranked.orderBy(_order(by, descending), *[field(c) for c in tie_break]).limit(k)
    if ties == "cut":
        return best
    if ties != "keep":
        raise ValueError(f"unknown ties rule {ties!r}")
    bound = (
        ranked.select(field(by))
        .orderBy(_order(by, descending))
        .limit(k)
        .agg(_last(by, descending))
        .scalar()
    )
    return ranked.filter(_at_or_beyond(by, bound, descending)).orderBy(
        _order(by, descending), *[field(c) for c in tie_break]
    )


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    k: int,
    by: str,
    tie_break: Sequence[str],
    *,
    descending: bool = True,
    ties: str = "cut",
    rank_name: str | None = None,
) -> DataFrame:
    """The k best rows of every group.

    ``cut``: Spark limits each group to k rows per task before the shuffle, so a hot
    group sends k rows from each task; a k beyond that rule's threshold is taken from
    the sliced full ranking.  ``keep``: the k-th value per group comes from those few
    rows and is joined back, which AQE may broadcast or split.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    if ties not in ("cut", "keep"):
        raise ValueError(f"unknown ties rule {ties!r}")
    if ties == "keep" and rank_name:
        raise ValueError("with ties kept the rows of a group carry no row number")
    if ties == "keep":  # rows without a value are never among the best
        df = df.filter(field(by).isNotNull())
    window = Window.partitionBy(*[field(c) for c in group]).orderBy(
        _order(by, descending), *[field(c) for c in tie_break]
    )
    rank_column = rank_name or "_rank"
    if k <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        cut = df.withColumn(rank_column, F.row_number().over(window))
    else:
        cut = rank_in_group(df, group, by, tie_break, descending=descending, name=rank_column)
    cut = cut.filter(field(rank_column) <= k)
    if ties == "cut":
        return cut if rank_name else cut.drop(rank_column)
    bounds = cut.groupBy(*[field(c).alias(f"_g{i}") for i, c in enumerate(group)]).agg(
        _last(by, descending).alias("_bound")
    )
    same_group = [field(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    matched = df.join(bounds, [*same_group, _at_or_beyond(by, F.col("_bound"), descending)])
    return matched.select(*[field(c) for c in df.columns])


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    tie_break: Sequence[str],
    *,
    descending: bool = True,
    name: str = "rank",
) -> DataFrame:
    """Row number of every row in its group, however large a group is.

    The rows are range-partitioned by group and order, which cuts a large group into
    consecutive slices; each slice numbers its own rows, and the sizes of a group's
    earlier slices are added.  The sliced rows are checkpointed, so that the numbers
    and the sizes always speak of the same slices.
    """
    order = [_order(by, descending), *[field(c) for c in tie_break]]
    keys = [field(c) for c in group]
    sliced = materialise(df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()))
    in_slice = Window.partitionBy(*keys, F.col("_slice")).orderBy(*order)
    numbered = sliced.withColumn("_number", F.row_number().over(in_slice))

    before = Window.partitionBy(*[F.col(f"_g{i}") for i in range(len(group))]).orderBy("_s")
    offsets = (
        sliced.groupBy(*[field(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_slice").alias("_s"))
        .agg(F.count("*").alias("_size"))
        .withColumn("_before", F.sum("_size").over(before) - F.col("_size"))
        .drop("_size")
    )
    same_slice = [field(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    return numbered.join(offsets, [*same_slice, F.col("_slice") == F.col("_s")]).select(
        *[field(c) for c in df.columns], (F.col("_number") + F.col("_before")).alias(name)
    )
