"""Explicit schemas of the four JSON streams (no inference on streams)."""
from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)


def _s(*fields):
    return StructType([StructField(n, t) for n, t in fields])


S, D, I, L, TS = StringType(), DoubleType(), IntegerType(), LongType(), TimestampType()

TRANSPORT = _s(("vehicle_id", S), ("route_id", S), ("route_mode", S), ("trip_id", S), ("direction_id", I),
               ("stop_id", S), ("next_stop_id", S), ("lat", D), ("lon", D), ("speed_kmh", D), ("heading_deg", D),
               ("delay_seconds", D), ("congestion_level", D), ("event_ts", TS))
TRIP_UPDATES = _s(("trip_id", S), ("route_id", S), ("vehicle_id", S), ("stop_id", S), ("stop_sequence", I),
                  ("scheduled_arrival_utc", TS), ("actual_arrival_utc", TS), ("delay_seconds", D), ("status", S),
                  ("event_ts", TS))
WEATHER = _s(("zone_id", S), ("lat", D), ("lon", D), ("temperature_c", D), ("feels_like_c", D), ("humidity_pct", D),
             ("wind_speed_kmh", D), ("precipitation_mm", D), ("condition", S), ("visibility_km", D), ("event_ts", TS))
CITY_EVENTS = _s(("event_id", S), ("name", S), ("category", S), ("lat", D), ("lon", D), ("start_time_utc", TS),
                 ("end_time_utc", TS), ("expected_attendance", L), ("impact", D), ("impact_radius_km", D),
                 ("status", S), ("event_ts", TS))

STREAMS = {
    "transport_positions": TRANSPORT,
    "trip_updates": TRIP_UPDATES,
    "weather_observations": WEATHER,
    "city_events": CITY_EVENTS,
}

# Topic names of the four streams.
TOPICS = {
    "transport_positions": "raw.transport.vehicle.positions",
    "trip_updates": "raw.transport.trip.updates",
    "weather_observations": "raw.weather.observations",
    "city_events": "raw.city.events",
}
