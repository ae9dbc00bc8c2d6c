"""Aggregate building blocks beyond the built-ins."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise


def nearest_rank(value: str, q: float) -> Column:
    """Nearest-rank percentile ``sorted(values)[int(q * (n - 1))]``.

    Only for groups with a proven bound (the live window holds at most a few
    thousand rows): it sorts the group's values in one buffer.
    """
    n = F.count(F.col(value))
    return F.element_at(F.array_sort(F.collect_list(F.col(value))), (F.floor(F.lit(q) * (n - 1)) + 1).cast("int"))


def weighted_nearest_rank(df: DataFrame, group: list[str], value: str, weight: str, q: float,
                          alias: str) -> DataFrame:
    """Nearest-rank percentile where each row stands for ``weight`` copies of
    its value: the element at 0-based index floor(q * (n - 1)) of the
    expanded sorted multiset, found with a running sum of weights instead of
    materialising the copies."""
    w_all = Window.partitionBy(*group)
    w_run = Window.partitionBy(*group).orderBy(F.col(value)).rowsBetween(Window.unboundedPreceding, 0)
    k = F.floor(F.lit(q) * (F.sum(weight).over(w_all) - 1))
    ranked = df.select(*group, value, (F.sum(weight).over(w_run)).alias("_cum"), k.alias("_k"))
    return ranked.groupBy(*group).agg(F.min(F.when(F.col("_cum") > F.col("_k"), F.col(value))).alias(alias))


#: Value ranges that one pass divides the open range of a rank into.
RANGES = 256


def _open_ranks(counted: DataFrame, group_cols: list[str], qs: dict[str, float]) -> DataFrame:
    """One row for each group and rank (0-based) that a percentile needs: the range that holds it, and how many values
    lie below that range."""
    totals = counted.groupBy(*group_cols).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    at = [f(F.lit(q) * (F.col("_n") - 1)).cast("long") for q in qs.values() for f in (F.floor, F.ceil)]
    return totals.withColumn("_rank", F.explode(F.array_distinct(F.array(*at)))).withColumn("_below", F.lit(0).cast("long"))


def _narrowed(counted: DataFrame, open_: DataFrame, group_cols: list[str], ranges: int) -> DataFrame:
    """open_ with the one of the parts of each range that holds the rank, cut to the values that are there."""
    renamed = open_.select(*[F.col(c).alias(f"_of_{c}") for c in group_cols], "_n", "_rank", "_low", "_high", "_below")
    same = [counted[c].eqNullSafe(renamed[f"_of_{c}"]) for c in group_cols]
    inside = counted.join(renamed, [*same, F.col("_v").between(F.col("_low"), F.col("_high"))])
    share = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)  # halves: no overflow
    part = F.least(F.floor(share * ranges), F.lit(ranges - 1))
    key = [*group_cols, "_n", "_rank", "_below"]
    parts = inside.groupBy(*key, part.alias("_part")).agg(
        F.sum("_c").alias("c"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    # at most ``ranges`` entries
    listed = parts.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_part", "c", "low", "high"))).alias("_parts"))
    none = F.struct(F.col("_below").alias("below"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    found = F.reduce("_parts", none, lambda at, x: F.when(at["low"].isNotNull(), at).when(
        at["below"] + x["c"] > F.col("_rank"), F.struct(at["below"].alias("below"), x["low"].alias("low"), x["high"].alias("high")))
        .otherwise(F.struct((at["below"] + x["c"]).alias("below"), at["low"].alias("low"), at["high"].alias("high"))))
    return listed.withColumn("_f", found).select(*group_cols, "_n", F.col("_f.low").alias("_low"), F.col("_f.high").alias("_high"),
                                                 "_rank", F.col("_f.below").alias("_below"))


def exact_percentiles(df: DataFrame, group_cols: list[str], value: str, qs: dict[str, float],
                      ranges: int = RANGES) -> DataFrame:
    """Exact interpolated percentiles (percentile_cont): group columns + one column per entry of ``qs`` (name -> q).

    Rank selection by refined histograms. Rows are first counted by (group, value), written once. Then the range of a
    group's values is divided into ``ranges`` parts and counted; the part that holds a wanted rank is divided again, until it
    holds one value. Every pass is a sum by (group, rank, part) that combines before the shuffle, so a hot group is spread
    over all tasks, and what a task keeps of a group is that many counts. Passes needed: about the logarithm of range over
    resolution to that base (two for delays in whole seconds). Null, infinite and NaN values take no part."""
    v = F.col(value).cast("double")
    finite = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    counted = materialise(finite.groupBy(*group_cols, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c")), "counted")
    open_ = materialise(_open_ranks(counted, group_cols, qs), "ranks")
    done = open_.where("_low = _high")
    while not (open_ := open_.where("_low < _high")).isEmpty():
        open_ = materialise(_narrowed(counted, open_, group_cols, ranges), "ranks")
        done = done.unionByName(open_.where("_low = _high"))
    aggs = []
    for name, q in qs.items():
        pos = F.lit(q) * (F.col("_n") - 1)
        low = F.max(F.when(F.col("_rank") == F.floor(pos), F.col("_low")))
        high = F.max(F.when(F.col("_rank") == F.ceil(pos), F.col("_low")))
        frac = F.first(pos - F.floor(pos))
        aggs.append(F.when(low == high, low).otherwise((F.lit(1.0) - frac) * low + frac * high).alias(name))
    return done.groupBy(*group_cols).agg(*aggs)
