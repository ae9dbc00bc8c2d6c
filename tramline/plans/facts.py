"""Fact tables: trip delays (the flagship star join), vehicle positions and
the ML feature table."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.buckets import delay_bucket
from ..functions.geo import cell_coord, grid_cell
from ..functions.timefn import day_of_week, hour_of_day, is_rush_hour
from ..operators.joins import stop_segments, with_weather
from ..operators.nearest import RADII_KM, with_nearest_event
from ..params import DEFAULT_CITY, MIN_FEATURE_DELAY, CityProfile

FACT_COLUMNS = ["trip_id", "route_id", "vehicle_id", "stop_id", "stop_sequence", "delay_seconds", "delay_bucket",
                "status", "event_ts", "hour_of_day", "day_of_week", "is_rush_hour", "route_mode", "segment_km",
                "stop_zone_num", "weather_zone_id", "temperature_c", "precipitation_mm", "wind_speed_kmh",
                "humidity_pct", "condition", "event_proximity_km", "nearest_event_impact", "event_nearby",
                "historical_avg_delay"]


def route_stop_avg(stg_trip_updates: DataFrame) -> DataFrame:
    return stg_trip_updates.groupBy("route_id", "stop_id").agg(F.avg("delay_seconds").alias("historical_avg_delay"))


EVENT_COLUMNS = ["event_proximity_km", "nearest_event_impact", "event_nearby"]


def fct_trip_delays(stg_trip_updates: DataFrame, stg_events: DataFrame | None, weather_hourly: DataFrame,
                    dim_stops: DataFrame, dim_trips: DataFrame, dim_routes: DataFrame,
                    dim_stop_times: DataFrame, stamp: bool = False, city: CityProfile = DEFAULT_CITY,
                    radii_km: tuple = RADII_KM) -> DataFrame:
    """One row per valid trip update, more where a dimension or the segment join on (trip_id, stop_id) repeats.

    Left joins only: the update stream is neither multiplied by events nor aggregated. The nearest active event comes
    from a search over distinct (stop, time), see :mod:`tramline.operators.nearest`; without ``stg_events`` the fact has
    no event columns, and marts that need none don't wait for that search. Spark picks the join strategies from measured
    sizes.
    """
    tu = stg_trip_updates.select("trip_id", "route_id", "vehicle_id", "stop_id", "stop_sequence",
                                 "delay_seconds", "status", "event_ts")
    stops = dim_stops.select("stop_id", "stop_lat", "stop_lon", "stop_zone_num")
    trips = dim_trips.select("trip_id", F.col("route_id").alias("_t_route"))
    routes = dim_routes.select(F.col("route_id").alias("_r_route"), "route_mode")
    at_stop = tu.join(stops, "stop_id", "left")
    if stg_events is not None:
        at_stop = with_nearest_event(at_stop, stg_events, radii_km=radii_km)
    fact = (at_stop.join(trips, "trip_id", "left")
            .join(routes, F.col("_r_route") == F.coalesce(F.col("_t_route"), F.col("route_id")), "left"))
    # weather of the stop's zone in the update hour (NULL when the stop is unknown)
    fact = with_weather(fact, weather_hourly, "stop_lat", "stop_lon", city_lat=city.lat, city_lon=city.lon)
    segments = stop_segments(dim_stop_times, dim_stops).select("trip_id", "stop_id", "segment_km")
    fact = fact.join(segments, ["trip_id", "stop_id"], "left") \
        .join(route_stop_avg(stg_trip_updates), ["route_id", "stop_id"], "left")
    columns = {
        "delay_bucket": delay_bucket("delay_seconds"), "hour_of_day": hour_of_day("event_ts"),
        "day_of_week": day_of_week("event_ts"), "is_rush_hour": is_rush_hour("event_ts"),
        "segment_km": F.coalesce("segment_km", F.lit(0.0)), "stop_zone_num": F.coalesce("stop_zone_num", F.lit(0)),
        "weather_zone_id": F.coalesce(F.col("zone_id"), F.lit("unknown")),
        "condition": F.coalesce("condition", F.lit("unknown")),
        "historical_avg_delay": F.coalesce("historical_avg_delay", F.lit(0.0))}
    if stg_events is not None:
        columns |= {"event_proximity_km": F.coalesce("event_proximity_km", F.lit(10.0)),
                    "nearest_event_impact": F.coalesce("nearest_impact", F.lit(0.0)),
                    "event_nearby": F.when(F.col("event_proximity_km").isNotNull(), F.lit(1)).otherwise(F.lit(0))}
    out = fact.select(*[columns.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS if stg_events is not None or c not in EVENT_COLUMNS])
    return out.withColumn("dbt_loaded_at", F.current_timestamp()) if stamp else out


def fct_vehicle_positions(stg_positions: DataFrame, weather_hourly: DataFrame, digits: int = 2,
                          city: CityProfile = DEFAULT_CITY) -> DataFrame:
    tp = stg_positions.select("vehicle_id", "route_id", "route_mode", "trip_id", "stop_id", "lat", "lon",
                              "speed_kmh", "heading_deg", "delay_seconds", "congestion_level", "event_ts")
    tp = tp.withColumn("delay_bucket", delay_bucket("delay_seconds")) \
           .withColumn("grid_cell", grid_cell("lat", "lon", digits)) \
           .withColumn("cell_lat", cell_coord("lat", digits).cast("double")) \
           .withColumn("cell_lon", cell_coord("lon", digits).cast("double"))
    out = with_weather(tp, weather_hourly, "lat", "lon",
                       cols=("zone_id", "condition", "precipitation_mm", "wind_speed_kmh"),
                       city_lat=city.lat, city_lon=city.lon)
    return out.select("vehicle_id", "route_id", "route_mode", "trip_id", "stop_id", "lat", "lon", "speed_kmh",
                      "heading_deg", "delay_seconds", "delay_bucket", "congestion_level", "event_ts", "grid_cell",
                      "cell_lat", "cell_lon", F.col("zone_id").alias("weather_zone_id"), "condition",
                      "precipitation_mm", "wind_speed_kmh")


ML_FEATURE_COLUMNS = ["trip_id", "route_id", "stop_id", "delay_seconds", "hour_of_day", "day_of_week",
                      "is_rush_hour", "route_mode", "segment_km", "stop_zone_num", "temperature_c",
                      "precipitation_mm", "wind_speed_kmh", "humidity_pct", "condition", "event_proximity_km",
                      "event_nearby", "historical_avg_delay", "event_ts"]


def ml_features(fact: DataFrame, min_delay: float = MIN_FEATURE_DELAY) -> DataFrame:
    return fact.where(F.col("delay_seconds") >= min_delay).select(*ML_FEATURE_COLUMNS)
