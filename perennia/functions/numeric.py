"""Numbers that come out the same however the rows were partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.functions.columns import field


def exact_means(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """keys and the mean of a double per group, the same to the last bit in whatever order rows arrive.

    A sum of doubles differs in its last bits from run to run, which breaks a comparison
    between a group's mean and a k-th mean computed elsewhere in the plan.  So each
    finite value is written as whole multiples of 2 ** (32 * slot) in up to three slots; the
    multiples of a slot are summed exactly, and a group's few slots are added in a fixed
    order.  The whole range of doubles is kept.  Infinities give an infinite mean, or NaN
    where both signs meet; null and NaN values do not count.
    """
    named = [field(k).alias(k) for k in keys]
    rows = df.select(*named, value.alias("_v")).withColumn("_v", F.when(~F.isnan("_v"), F.col("_v")))
    finite = F.abs("_v") < float("inf")
    top = F.when(finite & (F.col("_v") != 0), F.floor(F.log2(F.abs("_v")) / 32)).cast("int")
    rows = rows.withColumn("_slot", top)
    parts, rest = [], F.col("_v")
    for k in range(3):
        unit = F.pow(F.lit(2.0), 32.0 * (F.col("_slot") - k))
        share = F.when(unit > 0, rest / F.when(unit > 0, unit)).otherwise(0.0)
        whole = F.when(share < 0, F.ceil(share)).otherwise(F.floor(share))
        parts.append(F.struct((F.col("_slot") - k).alias("slot"), whole.cast("decimal(20,0)").alias("part")))
        rest = rest - whole.cast("double") * unit
    one = F.lit(1).cast("decimal(20,0)")
    counted = F.struct(F.lit(_COUNT).alias("slot"), F.when(F.col("_v").isNotNull(), one).otherwise(one - one).alias("part"))
    endless = F.struct(F.when(F.col("_v") > 0, F.lit(_MORE)).otherwise(F.lit(_LESS)).alias("slot"), one.alias("part"))
    several = F.when(top.isNotNull(), F.array(counted, *parts)).when(~finite, F.array(counted, endless)).otherwise(F.array(counted))
    slots = rows.select(*[field(k) for k in keys], F.inline(several))
    sums = slots.groupBy(*[field(k) for k in keys], "slot").agg(F.sum("part").cast("double").alias("sum"))
    # a group has as many sums as there are slots, some seventy at most
    listed = sums.groupBy(*[field(k) for k in keys]).agg(
        F.max(F.when(F.col("slot") == _COUNT, F.col("sum"))).alias("_n"),
        F.count_if(F.col("slot") == _MORE).alias("_more"),
        F.count_if(F.col("slot") == _LESS).alias("_less"),
        F.sort_array(F.collect_list(F.when(F.abs("slot") < 1000, F.struct("slot", "sum"))), asc=False).alias("_sums"),
    )
    total = F.aggregate(
        "_sums", F.lit(0.0), lambda t, s: t + s["sum"] * F.pow(F.lit(2.0), 32.0 * s["slot"])
    )
    signed = F.when(F.col("_more") * F.col("_less") > 0, float("nan")).when(F.col("_more") > 0, float("inf"))
    total = signed.when(F.col("_less") > 0, float("-inf")).otherwise(total)
    return listed.select(*[field(k) for k in keys], F.try_divide(total, F.col("_n")).alias(name))


#: Slots that do not stand for a power of two: values counted, and infinities of either sign.
_COUNT, _MORE, _LESS = 1000, 1001, 1002


def hash_unit(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the key values and the seed only.

    The first 32 bits of the MD5 of ``key:...:seed``; null keys hash as ``\\N``.
    """
    parts = [F.coalesce(field(key).cast("string"), F.lit("\\N")) for key in keys]
    digest = F.md5(F.concat_ws(":", *parts, F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
