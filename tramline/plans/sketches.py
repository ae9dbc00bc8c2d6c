"""Approximate reliability from sketches stored by day: distinct trips (HyperLogLog) and delay quantiles (KLL).

A day's sketches are built once, from that day's rows; any range of dates merges them without reading the fact again.
Stated errors: DISTINCT_ERROR of the number of trips (three standard errors of 2^LOG_K registers) and RANK_ERROR of a
quantile's rank (KLL with K items, at 99 %)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import read_layer, write_layer

LOG_K = 12
K = 400
DISTINCT_ERROR = 0.05
RANK_ERROR = 0.01

KEYS = ["route_id", "route_mode"]


def daily_sketches(fact: DataFrame) -> DataFrame:
    """One row for each route, mode and service date. The buffers are of bounded size and combine before the shuffle."""
    return fact.groupBy(*KEYS, F.to_date("event_ts").alias("service_date")).agg(
        F.count(F.lit(1)).alias("observations"),
        F.hll_sketch_agg("trip_id", LOG_K).alias("trips_sketch"),
        F.kll_sketch_agg_double("delay_seconds", K).alias("delay_sketch"))


def store(fact: DataFrame, path: str) -> None:
    """Only the service dates of ``fact`` are replaced."""
    write_layer(daily_sketches(fact), path, "service_date", keep_other_dates=True)


def merged(spark: SparkSession, path: str, first=None, last=None, qs: dict[str, float] | None = None) -> DataFrame:
    """Per route and mode over the stored dates from first to last (None: all): observations, approximate distinct trips
    and delay quantiles."""
    days = read_layer(spark, path)
    if first is not None:
        days = days.where(F.col("service_date") >= F.lit(first).cast("date"))
    if last is not None:
        days = days.where(F.col("service_date") <= F.lit(last).cast("date"))
    whole = days.groupBy(*KEYS).agg(F.sum("observations").alias("observations"),
                                    F.hll_union_agg("trips_sketch").alias("_trips"),
                                    F.kll_merge_agg_double("delay_sketch").alias("_delays"))
    qs = qs or {"median_delay_seconds": 0.5, "p95_delay_seconds": 0.95}
    return whole.select(*KEYS, "observations", F.hll_sketch_estimate("_trips").alias("trips"), *[
        F.kll_sketch_get_quantile_double("_delays", F.lit(q)).alias(n) for n, q in qs.items()])


def errors(approximate: DataFrame, fact: DataFrame, qs: dict[str, float]) -> DataFrame:
    """Per route and mode the exact counts, and by how much the sketches are off: the share of the distinct trips, and
    for each quantile how far its share of rows below lies from the share asked for."""
    a = approximate.select(*[F.col(c).alias(f"_{c}") for c in approximate.columns])
    rows = fact.join(a, [fact[k].eqNullSafe(a[f"_{k}"]) for k in KEYS])
    n = F.count(F.lit(1))
    off = []
    for name, q in qs.items():
        below, upto = (F.count_if(F.col("delay_seconds") < F.col(f"_{name}")) / n, F.count_if(F.col("delay_seconds") <= F.col(f"_{name}")) / n)
        off.append(F.greatest(below - q, F.lit(q) - upto, F.lit(0.0)).alias(f"{name}_rank_error"))
    trips = F.count_distinct("trip_id")
    return rows.groupBy(*KEYS).agg(n.alias("observations"), trips.alias("trips"), F.max("_observations").alias("sketched"),
                                   (F.abs(F.max("_trips") - trips) / trips).alias("trips_error"), *off)
