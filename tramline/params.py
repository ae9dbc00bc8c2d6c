"""Parameters of the transit model.

Fixed values below must equal the reference pipeline's for equal results.
"""
from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------- fixed values
# City centre used by the zone formula and the SQL models (Berlin).
CITY_LAT = 52.52
CITY_LON = 13.405
# Silver bounding box (Berlin).
BOUNDS = {"lat_min": 52.35, "lat_max": 52.68, "lon_min": 13.08, "lon_max": 13.75}
MAX_SPEED_KMH = 140.0
MAX_DELAY_SEC = 3600.0
ON_TIME_THRESHOLD_SECONDS = 120
SEVERE_DELAY_THRESHOLD_SECONDS = 600
EARTH_RADIUS_KM = 6371.0
WEATHER_GRID_DEG = 0.03
WEATHER_GRID_OFFSET = 2
VALID_CONDITIONS = ["clear", "clouds", "rain", "snow", "fog", "storm", "sleet"]
RUSH_HOURS = [7, 8, 9, 17, 18, 19]
# Loader mapping route_mode -> GTFS route_type, and the constant agency.
ROUTE_TYPE_BY_MODE = {"rail": 2, "tram": 0, "bus": 3}
AGENCY_ID = "DE"
# GTFS route_type (standard and extended codes) -> simulator mode; default bus.
ROUTE_MODE_BY_TYPE = {
    0: "tram", 1: "rail", 2: "rail", 3: "bus", 4: "bus", 5: "tram",
    6: "rail", 7: "tram", 11: "bus", 12: "bus",
    100: "rail", 101: "rail", 102: "rail", 103: "rail", 104: "rail",
    105: "rail", 106: "rail", 107: "rail", 108: "rail", 109: "rail",
    110: "rail", 111: "bus", 112: "bus",
    200: "bus", 201: "bus", 202: "bus", 203: "bus", 204: "bus",
    205: "bus", 206: "bus", 207: "bus", 208: "bus",
    400: "rail", 401: "rail", 402: "rail", 403: "rail", 404: "rail",
    700: "bus", 701: "bus", 702: "bus", 703: "bus", 704: "bus",
    705: "bus", 706: "bus", 707: "bus", 708: "bus", 709: "bus",
    710: "bus", 711: "bus", 712: "bus", 713: "bus", 714: "bus",
    715: "bus", 716: "bus", 717: "bus",
    800: "bus",
    900: "tram", 901: "tram", 902: "tram", 903: "tram", 904: "tram", 905: "tram",
    1000: "bus", 1100: "bus", 1200: "bus",
    1300: "rail", 1400: "tram", 1500: "bus", 1700: "bus", 1702: "bus",
}
# Live-window sizes.
LIVE_WINDOW_ROWS = 5000
LIVE_RECENT_ROWS = 1500
# Realtime poller: cap of records per poll, status thresholds.
MAX_RECORDS_PER_POLL = 600
EARLY_BELOW_SECONDS = -60
# GTFS city extraction radius.
BBOX_RADIUS_KM = 25.0
# Implausible earliness cut of the feature table.
MIN_FEATURE_DELAY = -120
TRIP_STATUSES = ["EARLY", "ON_TIME", "DELAYED"]
EVENT_STATUSES = ["ACTIVE", "ENDED"]
WEATHER_CONDITIONS_ALL = ["clear", "clouds", "rain", "snow", "fog", "storm", "sleet", "unknown"]
TRANSPORT_COLUMNS = ["vehicle_id", "route_id", "route_mode", "trip_id",
                     "direction_id", "stop_id", "next_stop_id", "lat", "lon",
                     "speed_kmh", "heading_deg", "delay_seconds",
                     "congestion_level", "event_ts", "ingested_ts",
                     "dqr_speed_anomaly", "dqr_delay_anomaly", "dqr_valid",
                     "processed_ts"]
# Quality rules: (type, column, arguments) per Silver table and per model.
SILVER_RULES = {
    "transport_positions": [
        ("expect_table_columns_to_match_ordered_list", None, {"column_list": TRANSPORT_COLUMNS}),
        ("expect_column_values_to_not_be_null", "vehicle_id", {}),
        ("expect_column_values_to_not_be_null", "route_id", {}),
        ("expect_column_values_to_be_between", "lat", {"min_value": -90.0, "max_value": 90.0}),
        ("expect_column_values_to_be_between", "lon", {"min_value": -180.0, "max_value": 180.0}),
        ("expect_column_values_to_be_between", "speed_kmh", {"min_value": 0.0, "max_value": 150.0}),
        ("expect_column_values_to_be_between", "delay_seconds", {"min_value": -3600.0, "max_value": 36000.0}),
        ("expect_column_values_to_be_of_type", "lat", {"type_": "float64"}),
    ],
    "trip_updates": [
        ("expect_column_values_to_not_be_null", "trip_id", {}),
        ("expect_column_values_to_not_be_null", "stop_id", {}),
        ("expect_column_values_to_not_be_null", "delay_seconds", {}),
        ("expect_column_values_to_be_between", "delay_seconds", {"min_value": -3600.0, "max_value": 36000.0}),
        ("expect_column_values_to_be_in_set", "status", {"value_set": TRIP_STATUSES}),
    ],
    "weather_observations": [
        ("expect_column_values_to_not_be_null", "zone_id", {}),
        ("expect_column_values_to_be_between", "temperature_c", {"min_value": -50.0, "max_value": 60.0}),
        ("expect_column_values_to_be_between", "humidity_pct", {"min_value": 0.0, "max_value": 100.0}),
        ("expect_column_values_to_be_in_set", "condition", {"value_set": WEATHER_CONDITIONS_ALL}),
    ],
    "city_events": [
        ("expect_column_values_to_not_be_null", "event_id", {}),
        ("expect_column_values_to_be_between", "lat", {"min_value": -90.0, "max_value": 90.0}),
        ("expect_column_values_to_be_between", "lon", {"min_value": -180.0, "max_value": 180.0}),
        ("expect_column_values_to_be_in_set", "status", {"value_set": EVENT_STATUSES}),
    ],
}
MODEL_RULES = {
    "fct_trip_delays": [
        ("expect_column_values_to_not_be_null", "trip_id", {}),
        ("expect_column_values_to_not_be_null", "stop_id", {}),
        ("expect_column_values_to_not_be_null", "delay_seconds", {}),
        ("accepted_values", "delay_bucket", {"values": ["on_time", "delayed", "severe"]}),
        ("expect_column_values_to_not_be_null", "route_id", {}),
    ],
    "fct_vehicle_positions": [
        ("expect_column_values_to_not_be_null", "vehicle_id", {}),
        ("expect_column_values_to_not_be_null", "grid_cell", {}),
    ],
    "mart_route_reliability": [
        ("expect_column_values_to_not_be_null", "route_id", {}),
        ("expect_column_values_to_not_be_null", "on_time_pct", {}),
        ("greater_than_equal_zero", "on_time_pct", {}),
    ],
    "mart_congestion_hotspots": [("expect_column_values_to_not_be_null", "grid_cell", {})],
    "mart_delay_trends": [
        ("expect_column_values_to_not_be_null", "hour_of_day", {}),
        ("accepted_values", "hour_of_day", {"values": list(range(24))}),
    ],
}
GTFS_RULES = {
    "gtfs_stops": [("expect_column_values_to_not_be_null", "stop_id", {})],
    "gtfs_stop_times": [("expect_column_values_to_not_be_null", "trip_id", {})],
    "gtfs_trips": [("expect_column_values_to_not_be_null", "trip_id", {})],
    "gtfs_routes": [("expect_column_values_to_not_be_null", "route_id", {})],
}
# ML feature contract.
CAT_FEATURES = ["route_mode", "condition", "day_of_week"]
NUM_FEATURES = ["hour_of_day", "is_rush_hour", "segment_km", "temperature_c",
                "precipitation_mm", "wind_speed_kmh", "event_proximity_km",
                "event_nearby", "historical_avg_delay", "stop_zone_num"]
BUCKET_MAP = {"on_time": 0, "delayed": 1, "severe": 2}
# ------------------------------------------------------------ end fixed values


@dataclass(frozen=True)
class CityProfile:
    """A city the pipeline models; bounds derive from it (the reference hard-codes
    Berlin bounds while shipping another active city)."""
    name: str = "Berlin"
    lat: float = CITY_LAT
    lon: float = CITY_LON
    bounds: dict = field(default_factory=lambda: dict(BOUNDS))


@dataclass(frozen=True)
class Thresholds:
    on_time: float = ON_TIME_THRESHOLD_SECONDS
    severe: float = SEVERE_DELAY_THRESHOLD_SECONDS


DEFAULT_CITY = CityProfile()
DEFAULT_THRESHOLDS = Thresholds()


def load_city_catalog(spark, path: str):
    """Switchable cities: a JSON array of {name, lat, lon} as a DataFrame."""
    return spark.read.option("multiLine", True).json(path)


def city_profile(catalog, name: str) -> CityProfile:
    """Bind one catalog row as the active city (bounds derived from a box
    around its centre, as the city extraction does)."""
    from pyspark.sql import functions as F
    row = catalog.where(F.col("name") == name).select("name", "lat", "lon").first()
    if row is None:
        raise KeyError(f"Unknown city '{name}'")
    import math
    lat_d = BBOX_RADIUS_KM / 111.0
    lon_d = BBOX_RADIUS_KM / (111.0 * max(math.cos(math.radians(row["lat"])), 0.2))
    return CityProfile(row["name"], float(row["lat"]), float(row["lon"]),
                       {"lat_min": row["lat"] - lat_d, "lat_max": row["lat"] + lat_d,
                        "lon_min": row["lon"] - lon_d, "lon_max": row["lon"] + lon_d})
