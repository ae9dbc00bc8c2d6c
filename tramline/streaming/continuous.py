"""Continuous Silver and live state as Structured Streaming queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import grid_cell
from ..functions.numeric import pct, round_metric
from ..operators.cleaning import KEYS, apply_rules
from ..params import DEFAULT_CITY, ON_TIME_THRESHOLD_SECONDS

DEFAULT_WATERMARK = "10 minutes"


def dedup_stream(stream: DataFrame, name: str, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Drop repeated keys seen within the watermark (state is bounded by it): the first row stays. Where corrected rows
    follow, ``state.upsert_writer`` keeps the latest instead."""
    return stream.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(KEYS[name])


def silver_flags(stream: DataFrame, name: str, city=DEFAULT_CITY) -> DataFrame:
    """The stateless part of Silver cleaning on a stream."""
    return apply_rules(stream, name, city)


def hourly_delay_trend(trip_updates: DataFrame, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """Tumbling one-hour windows, emitted once the watermark passes the window end (append mode); rows later than the
    watermark are dropped, and windows that are still open when a feed ends wait for its next rows."""
    valid = trip_updates.where(F.col("dqr_valid"))
    if watermark:
        valid = valid.withWatermark("event_ts", watermark)
    n = F.count(F.lit(1))
    g = valid.groupBy(F.window("event_ts", "1 hour"))
    return g.agg(n.alias("observations"), round_metric(F.avg("delay_seconds")).alias("avg_delay_seconds"),
                 pct(F.count_if(F.col("delay_seconds") <= ON_TIME_THRESHOLD_SECONDS), n).alias("on_time_pct")) \
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "observations", "avg_delay_seconds", "on_time_pct")


def sliding_hotspots(positions: DataFrame, watermark: str = DEFAULT_WATERMARK, length: str = "24 hours",
                     slide: str = "1 hour") -> DataFrame:
    """Sliding windows over cells. Rows are first summed by cell and slide; a window adds up the sums of its slides, so
    what is copied into every window is one row per cell and slide. Windows still open when a feed ends are not emitted."""
    valid = positions.where(F.col("dqr_valid")).withColumn("grid_cell", grid_cell("lat", "lon"))
    if watermark:
        valid = valid.withWatermark("event_ts", watermark)
    slides = valid.groupBy(F.window("event_ts", slide).alias("slide"), "grid_cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("delay_seconds").alias("delay"), F.count("delay_seconds").alias("n_delay"),
        F.sum("speed_kmh").alias("speed"), F.count("speed_kmh").alias("n_speed"))
    g = slides.groupBy(F.window(F.window_time("slide"), length, slide), "grid_cell")
    return g.agg(F.sum("n").alias("observations"),
                 round_metric(F.sum("delay") / F.sum("n_delay")).alias("avg_delay_seconds"),
                 round_metric(F.sum("speed") / F.sum("n_speed")).alias("avg_speed_kmh")) \
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "grid_cell", "observations", "avg_delay_seconds", "avg_speed_kmh")


def enrich_with_weather(positions_stream: DataFrame, weather_hourly_static: DataFrame) -> DataFrame:
    """Stream-static left join on (zone, hour). The static side is read again by every micro-batch: give a stored table."""
    from ..plans.facts import fct_vehicle_positions
    return fct_vehicle_positions(positions_stream.where(F.col("dqr_valid")), weather_hourly_static)


def capped_batch_writer(path: str, cap: int):
    """foreachBatch sink keeping the ``cap`` largest |delay| records of each
    micro-batch (a per-poll cap); idempotent per batch_id partition."""
    def write(batch: DataFrame, batch_id: int) -> None:
        top = batch.orderBy(F.desc(F.abs(F.col("delay_seconds"))), "trip_id", "stop_id", "event_ts").limit(cap)
        (top.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    return write
