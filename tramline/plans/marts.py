"""Marts over the facts, data tests over marts, and the read queries the
serving layer runs against them."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.buckets import precip_bucket, proximity_bucket, temp_bucket
from ..functions.numeric import pct, round_metric
from ..functions.timefn import hour_of_day
from ..operators.aggregates import RANGES, exact_percentiles
from ..params import WEATHER_CONDITIONS_ALL


def _n():
    return F.count(F.lit(1))


def _share(bucket: str):
    return F.count_if(F.col("delay_bucket") == bucket)


def _with_percentiles(stats: DataFrame, rows: DataFrame, keys: list[str], qs: dict[str, float],
                      ranges: int = RANGES) -> DataFrame:
    """Attach rounded exact percentiles of the delay; keys match null-safely (a route without mode is a group)."""
    ps = exact_percentiles(rows, keys, "delay_seconds", qs, ranges)
    out = stats.join(ps, [stats[k].eqNullSafe(ps[k]) for k in keys], "left")
    return out.select(*[stats[c] for c in stats.columns], *[round_metric(ps[q]).alias(q) for q in qs])


def route_reliability(fact: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Per (route, mode, service date): volumes, delay statistics, on-time and severe shares and the 0..100
    reliability score. Percentiles are exact and interpolated."""
    keys = ["route_id", "route_mode", "service_date"]
    f = fact.withColumn("service_date", F.to_date("event_ts"))
    stats = f.groupBy(*keys).agg(
        _n().alias("stops_observed"),
        F.count_distinct("trip_id").alias("trips"),
        round_metric(F.avg("delay_seconds")).alias("avg_delay_seconds"),
        round_metric(F.max("delay_seconds")).alias("max_delay_seconds"),
        pct(_share("on_time"), _n()).alias("on_time_pct"),
        pct(_share("severe"), _n()).alias("severe_pct"),
        round_metric(F.lit(100.0) * (F.lit(0.7) * _share("on_time") + F.lit(0.2) * _share("delayed"))
                     / F.nullif(_n(), F.lit(0))).alias("reliability_score"))
    out = _with_percentiles(stats, f, keys, {"p95_delay_seconds": 0.95, "median_delay_seconds": 0.5}, ranges)
    return out.select(*keys, "stops_observed", "trips", "avg_delay_seconds", "p95_delay_seconds",
                      "median_delay_seconds", "max_delay_seconds", "on_time_pct", "severe_pct", "reliability_score")


def delay_trends(fact: DataFrame) -> DataFrame:
    g = fact.groupBy(F.to_date("event_ts").alias("service_date"), hour_of_day("event_ts").alias("hour_of_day"))
    return g.agg(
        _n().alias("observations"),
        F.count_distinct("trip_id").alias("trips"),
        round_metric(F.avg("delay_seconds")).alias("avg_delay_seconds"),
        round_metric(F.max("delay_seconds")).alias("max_delay_seconds"),
        pct(_share("on_time"), _n()).alias("on_time_pct"),
        pct(_share("severe"), _n()).alias("severe_pct"),
        round_metric(F.avg(F.when(F.col("is_rush_hour") == 1, F.col("delay_seconds")))).alias("avg_delay_rush_hour"))


def as_of_default(positions: DataFrame):
    """Scalar subquery: the newest event time in the input (stand-in for 'now')."""
    return positions.select(F.max("event_ts")).scalar()


# Silver (P8) closes the condition domain, so the latest condition of a cell
# can travel as a small integer: a fixed-width max_by buffer keeps the whole
# aggregation hash-based instead of sorting the fact for a string buffer.
def _conditions():
    return F.array(*[F.lit(c) for c in WEATHER_CONDITIONS_ALL])


def _condition_code(c):
    return F.nullif(F.array_position(_conditions(), c), F.lit(0))


def _condition_name(code):
    return F.coalesce(F.element_at(_conditions(), code.cast("int")), F.lit("unknown"))


def congestion_hotspots(positions_fact: DataFrame, as_of=None, window_hours: int = 24) -> DataFrame:
    """Per grid cell over the last ``window_hours`` before ``as_of`` (a time, a scalar column, or None: the newest
    event time of the input); ranked by average delay, ties by grid_cell. The cells lie in the city's bounding box
    at two decimals, a few thousand whatever the input, so the rank is a plain window."""
    if as_of is None:
        as_of = as_of_default(positions_fact)
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    recent = positions_fact.where(F.col("event_ts") >= as_of_col - F.expr(f"INTERVAL {int(window_hours)} HOURS"))
    agg = recent.groupBy("grid_cell", "cell_lat", "cell_lon").agg(
        _n().alias("observations"),
        F.count_distinct("vehicle_id").alias("vehicles"),
        round_metric(F.avg("speed_kmh")).alias("avg_speed_kmh"),
        round_metric(F.avg("congestion_level"), 3).alias("avg_congestion"),
        round_metric(F.avg("delay_seconds")).alias("avg_delay_seconds"),
        round_metric(F.avg("delay_seconds"), 6).alias("_rank_delay"),
        pct(_share("severe"), _n()).alias("severe_pct"),
        F.max_by(_condition_code(F.col("condition")), "event_ts").alias("_cond"))
    rank = F.row_number().over(Window.orderBy(F.desc("_rank_delay"), "grid_cell")).cast("long")
    return agg.withColumn("condition", _condition_name(F.col("_cond"))).withColumn("congestion_rank", rank) \
        .drop("_cond", "_rank_delay")


def weather_impact(fact: DataFrame) -> DataFrame:
    """Per (condition, precipitation bucket, temperature bucket)."""
    keys = ["condition", "precip_bucket", "temp_bucket"]
    f = fact.withColumn("precip_bucket", precip_bucket("precipitation_mm")) \
        .withColumn("temp_bucket", temp_bucket("temperature_c"))
    stats = f.groupBy(*keys).agg(
        _n().alias("observations"), round_metric(F.avg("delay_seconds")).alias("avg_delay_seconds"),
        pct(_share("on_time"), _n()).alias("on_time_pct"), pct(_share("severe"), _n()).alias("severe_pct"))
    return _with_percentiles(stats, f, keys, {"p95_delay_seconds": 0.95}).select(
        *keys, "observations", "avg_delay_seconds", "p95_delay_seconds", "on_time_pct", "severe_pct")


def events_impact(fact: DataFrame) -> DataFrame:
    """'no_event' needs a NULL distance, which the fact already coalesced to 10 km: those rows land in 'far', as in
    the reference."""
    f = fact.withColumn("proximity_bucket", proximity_bucket("event_proximity_km"))
    stats = f.groupBy("proximity_bucket").agg(
        _n().alias("observations"), round_metric(F.avg("delay_seconds")).alias("avg_delay_seconds"),
        pct(_share("on_time"), _n()).alias("on_time_pct"),
        round_metric(F.avg("nearest_event_impact"), 3).alias("avg_event_impact"))
    return _with_percentiles(stats, f, ["proximity_bucket"], {"p95_delay_seconds": 0.95}).select(
        "proximity_bucket", "observations", "avg_delay_seconds", "p95_delay_seconds", "on_time_pct", "avg_event_impact")


def kpis(fact: DataFrame) -> DataFrame:
    """Headline KPIs as one aggregation (not four scalar subqueries)."""
    return fact.agg(
        _n().alias("observations"),
        round_metric(F.avg("delay_seconds")).alias("avg_delay_seconds"),
        pct(_share("on_time"), _n()).alias("on_time_pct"),
        _share("severe").alias("severe_delays"))


# ----------------------------------------------------------------- data tests
def reliability_score_out_of_range(reliability: DataFrame) -> DataFrame:
    return reliability.where((F.col("reliability_score") < 0) | (F.col("reliability_score") > 100)) \
        .select("route_id", "service_date", "reliability_score")


def severe_share_violations(fact: DataFrame, max_share: float = 0.35) -> DataFrame:
    g = fact.groupBy("route_id", F.to_date("event_ts").alias("service_date")) \
        .agg(_n().alias("total"), _share("severe").alias("severe"))
    return g.where(F.col("severe") > F.lit(max_share) * F.col("total"))


# ---------------------------------------------------------------- read queries
def top_routes(reliability: DataFrame, limit: int = 10) -> DataFrame:
    return reliability.select("route_id", "route_mode", "service_date", "avg_delay_seconds", "p95_delay_seconds",
                              "on_time_pct", "severe_pct", "stops_observed") \
        .orderBy(F.desc("avg_delay_seconds"), "route_id", "service_date").limit(limit)


def latest_trends(trends: DataFrame, hours: int = 24) -> DataFrame:
    return trends.select("service_date", "hour_of_day", "observations", "avg_delay_seconds", "on_time_pct",
                         "severe_pct") \
        .orderBy(F.desc("service_date"), F.desc("hour_of_day")).limit(hours)


def top_hotspots(hotspots: DataFrame, limit: int = 25) -> DataFrame:
    return hotspots.select("grid_cell", F.col("cell_lat").alias("lat"), F.col("cell_lon").alias("lon"),
                           "avg_delay_seconds", "avg_speed_kmh", "avg_congestion", "vehicles", "severe_pct",
                           "congestion_rank") \
        .orderBy("congestion_rank").limit(limit)


def reliability_listing(reliability: DataFrame) -> DataFrame:
    return reliability.select("route_id", "route_mode", "service_date", "trips", "stops_observed", "on_time_pct",
                              "reliability_score", "avg_delay_seconds", "p95_delay_seconds") \
        .orderBy(F.desc("service_date"), F.asc("reliability_score"), "route_id")


def weather_impact_listing(wi: DataFrame) -> DataFrame:
    return wi.orderBy(F.desc("avg_delay_seconds"), "condition", "precip_bucket", "temp_bucket")


def events_impact_listing(ei: DataFrame) -> DataFrame:
    return ei.orderBy(F.desc("avg_delay_seconds"), "proximity_bucket")
