"""Staging views over Silver: valid-only projections, hourly weather, latest
event state."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import round_metric
from ..functions.timefn import hour_bucket
from .dedup import latest_per_key

STG_COLUMNS = {
    "transport_positions": ["vehicle_id", "route_id", "route_mode", "trip_id", "direction_id", "stop_id",
                            "next_stop_id", "lat", "lon", "speed_kmh", "heading_deg", "delay_seconds",
                            "congestion_level", "event_ts", "ingested_ts", "dqr_valid"],
    "trip_updates": ["trip_id", "route_id", "vehicle_id", "stop_id", "stop_sequence", "scheduled_arrival_utc",
                     "actual_arrival_utc", "delay_seconds", "status", "event_ts", "ingested_ts", "dqr_valid"],
    "weather_observations": ["zone_id", "lat", "lon", "temperature_c", "feels_like_c", "humidity_pct",
                             "wind_speed_kmh", "precipitation_mm", "condition", "visibility_km", "event_ts",
                             "ingested_ts", "dqr_valid"],
    "city_events": ["event_id", "name", "category", "lat", "lon", "start_time_utc", "end_time_utc",
                    "expected_attendance", "impact", "impact_radius_km", "status", "event_ts", "ingested_ts",
                    "dqr_valid"],
}


def staged(name: str, silver: DataFrame) -> DataFrame:
    """Valid rows only; ``filter(col)`` drops NULL flags exactly like IS TRUE."""
    return silver.where(F.col("dqr_valid")).select(*STG_COLUMNS[name])


def weather_hourly(silver_weather: DataFrame) -> DataFrame:
    w = silver_weather.where(F.col("dqr_valid"))
    return (w.groupBy("zone_id", hour_bucket("event_ts").alias("obs_hour"))
             .agg(round_metric(F.avg("temperature_c")).alias("temperature_c"),
                  round_metric(F.avg("precipitation_mm")).alias("precipitation_mm"),
                  round_metric(F.max("precipitation_mm")).alias("max_precipitation_mm"),
                  round_metric(F.avg("wind_speed_kmh")).alias("wind_speed_kmh"),
                  round_metric(F.avg("humidity_pct")).alias("humidity_pct"),
                  F.max_by("condition", "event_ts").alias("condition"),
                  F.count(F.lit(1)).alias("obs_count")))


def latest_event_state(events: DataFrame) -> DataFrame:
    """Latest record per event id (the final ENDED record wins over earlier ACTIVE ones)."""
    return latest_per_key(events, ["event_id"], "event_ts")


def active_events(events: DataFrame) -> DataFrame:
    return latest_event_state(events).where(F.col("status") == "ACTIVE")
