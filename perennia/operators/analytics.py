"""Grouped counts and means, one row per entity, and the three snapshot questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.functions import exact_means, field, is_integral, is_text, present_double, to_int, year_at_most
from perennia.operators.ranking import rank_in_group, top_k, top_k_per_group


def group_count(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    """Rows per key combination, counted in each task before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def group_avg(
    df: DataFrame, keys: Sequence[str], measure: str, name: str = "avg", *, exact: bool = False
) -> DataFrame:
    """Mean of a measure per group; null where a group has no value.

    ``exact`` makes the mean independent of the order in which rows arrive, to the last
    bit, which comparisons between groups need.  Texts that are no number do not count.
    """
    if exact:
        return exact_means(df, keys, present_double(df, measure), name)
    return df.groupBy(*[field(k) for k in keys]).agg(F.avg(present_double(df, measure)).alias(name))


def dedup_latest(
    df: DataFrame, keys: Sequence[str], period: str, *, tie_break: Sequence[str] | None = None, keep: str = "latest"
) -> DataFrame:
    """One whole row per key: the one of the newest (or earliest) period.

    Rows of the same period are told apart by ``tie_break``, by default all remaining
    columns, so the kept row is always the same one.  Each task keeps one row per key
    before the shuffle, so a key with very many rows is no burden to a single task.
    """
    if keep not in ("latest", "earliest"):
        raise ValueError(f"unknown keep rule {keep!r}")
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c != period]
    return top_k_per_group(df, keys, 1, period, tie_break, descending=keep == "latest")


def top_groups_by_contract(
    df: DataFrame,
    joined_by: int,
    limit: int,
    until_at_least: int,
    *,
    entity: Sequence[str],
    group: str,
    joined: str,
    until: str,
    period: str,
    name: str = "n",
    ties: str = "cut",
    drop_null_groups: bool = False,
) -> DataFrame:
    """Groups with the most entities that joined by a year and stay until a year.

    An entity that qualifies in several periods counts once, for the group of its
    newest qualifying row.
    """
    stays = to_int(df, until) if is_text(df.schema[until].dataType) else field(until)
    needed = list(dict.fromkeys([*entity, group, period]))
    qualified = df.filter(year_at_most(df, joined, joined_by) & (stays >= until_at_least)).select(
        *[field(c) for c in needed]
    )
    entities = dedup_latest(qualified, entity, period, tie_break=[group])
    if drop_null_groups:
        entities = entities.filter(field(group).isNotNull())
    return top_k(group_count(entities, field(group), name=name), limit, name, [group], ties=ties)


def extreme_groups_by_avg(
    df: DataFrame,
    k: int,
    *,
    group: str,
    measure: str,
    highest: bool = True,
    name: str = "avg",
    drop_null_groups: bool = False,
) -> DataFrame:
    """The k groups with the highest (or lowest) mean, plus all that equal the k-th.

    A negative k asks for the lowest; k = 0 and an empty input give no rows; groups
    without any value take no part.

    Plain sums give each group an interval that its mean lies in.  Only groups whose interval reaches
    the k-th best lower (or upper) end are summed exactly, from their rows alone.
    """
    if k < 0:
        highest, k = False, -k
    if drop_null_groups:
        df = df.filter(field(group).isNotNull())
    if is_integral(df.schema[measure].dataType):  # such sums are exact
        total = F.sum(field(measure).cast("decimal(38,0)")).cast("double")
        means = df.groupBy(field(group)).agg(F.try_divide(total, F.count(field(measure))).alias(name))
    else:
        near = _reaching(df, k, group, present_double(df, measure), highest)
        means = group_avg(near, [group], measure, name, exact=True)
    return top_k(means, k, name, [group], descending=highest, ties="keep")


def _reaching(df: DataFrame, k: int, group: str, value: Column, highest: bool) -> DataFrame:
    """The rows of the groups whose mean may be among the k best, ties included."""
    # n additions of doubles are off by n / 2 ** 53 of the sum of magnitudes at most; a mean, by that over n
    mean, size = F.avg("_v"), F.sum(F.abs("_v"))
    sums = df.select(field(group).alias("_g"), value.alias("_v")).filter("_v is not null").groupBy("_g").agg(
        mean.alias("_mean"), (size * 2.0**-50).alias("_off")
    )
    known = F.col("_off") < float("inf")  # else the sums ran over, or hold infinities
    endless = F.lit(float("inf"))
    ends = sums.select(
        "_g",
        F.when(known, F.col("_mean") - F.col("_off")).otherwise(-endless).alias("_low"),
        F.when(known, F.col("_mean") + F.col("_off")).otherwise(endless).alias("_high"),
    )
    sure, far, order = ("_low", "_high", F.desc) if highest else ("_high", "_low", F.asc)
    best = ends.select(sure).orderBy(order(sure)).limit(k)
    bound = best.agg(F.when(F.count("*") == k, F.min(sure) if highest else F.max(sure))).scalar()
    reaches = F.col(far) >= bound if highest else F.col(far) <= bound
    wanted = ends.filter(F.coalesce(reaches, F.lit(True))).select("_g")
    return df.join(wanted, field(group).eqNullSafe(F.col("_g")), "left_semi")


def mode_per_group(df: DataFrame, group: str, value: str, *, name: str = "n", ties: str = "cut") -> DataFrame:
    """The most frequent value of every group; equal counts go to the first value in order."""
    return top_k_per_group(_value_counts(df, group, value, name), [group], 1, name, [value], ties=ties)


def top_values_per_group(
    df: DataFrame, group: str, value: str, k: int, *, name: str = "n", rank_name: str = "rank"
) -> DataFrame:
    """The k most frequent values of every group, numbered from 1."""
    counts = _value_counts(df, group, value, name)
    return top_k_per_group(counts, [group], k, name, [value], rank_name=rank_name)


def rank_values_in_group(df: DataFrame, group: str, value: str, *, name: str = "n", rank_name: str = "rank") -> DataFrame:
    """All values of every group, numbered by falling count."""
    return rank_in_group(_value_counts(df, group, value, name), [group], name, [value], name=rank_name)


def _value_counts(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    return group_count(df, field(group), field(value), name=name)
