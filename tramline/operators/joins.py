"""Join operators: zone/hour weather join, stop segments (LAG), the tangent plane of the spatial searches."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.geo import haversine_km, weather_zone
from ..functions.timefn import hour_bucket
from ..params import CITY_LAT, CITY_LON

EVENT_COLS = ["event_id", "lat", "lon", "start_time_utc", "end_time_utc", "impact"]


def with_weather(df: DataFrame, weather_hourly: DataFrame, lat: str, lon: str, ts: str = "event_ts",
                 cols=("zone_id", "temperature_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct", "condition"),
                 city_lat: float = CITY_LAT, city_lon: float = CITY_LON) -> DataFrame:
    """Left join hourly zone weather on (zone of the point, hour of ts)."""
    # derived aggregate: AQE broadcasts it from its real shuffle size
    wh = weather_hourly.select("obs_hour", *cols).withColumnRenamed("zone_id", "_w_zone")
    keyed = df.withColumn("_zone", weather_zone(F.col(lat), F.col(lon), city_lat, city_lon)) \
              .withColumn("_obs_hour", hour_bucket(ts))
    out = keyed.join(wh, (keyed["_zone"] == wh["_w_zone"]) & (keyed["_obs_hour"] == wh["obs_hour"]), "left")
    return out.drop("_zone", "_obs_hour", "obs_hour").withColumnRenamed("_w_zone", "zone_id")


def stops_in_order(stop_times: DataFrame, stops: DataFrame, keep: tuple = ()) -> DataFrame:
    """Stops of each trip with their position and the coordinates of the stop before (a trip has tens of stops, so a
    window over the trip is one shuffle of small groups, and none where stop times are stored by trip). keep: further
    columns of the stop times."""
    w = Window.partitionBy("trip_id").orderBy("stop_sequence", "stop_id")
    st = stop_times.select("trip_id", "stop_id", "stop_sequence", *keep).join(
        stops.select("stop_id", "stop_lat", "stop_lon"), "stop_id")
    return st.select("trip_id", "stop_id", "stop_sequence", *keep, "stop_lat", "stop_lon",
                     F.row_number().over(w).cast("long").alias("position"),
                     F.lag("stop_lat").over(w).alias("prev_stop_lat"), F.lag("stop_lon").over(w).alias("prev_stop_lon"))


def stop_segments(stop_times: DataFrame, stops: DataFrame, keep: tuple = ()) -> DataFrame:
    """Per stop time: distance from the previous stop of the same trip (0 for the first stop)."""
    km = F.when(F.col("prev_stop_lat").isNull(), F.lit(0.0)).otherwise(
        haversine_km("prev_stop_lat", "prev_stop_lon", "stop_lat", "stop_lon"))
    return stops_in_order(stop_times, stops, keep).select("trip_id", "stop_id", "stop_sequence", *keep, km.alias("segment_km"))


# ------------------------------------------------------------------ grid search
def tangent_plane_km(lat, lon, lat0: float = CITY_LAT, lon0: float = CITY_LON):
    """(u, v) in km: the point on the sphere projected onto the tangent plane
    at (lat0, lon0). The planar distance between two projected points never
    exceeds their chord, hence never their great-circle distance, so it is a
    safe lower bound for pruning."""
    import math
    from ..params import EARTH_RADIUS_KM as R
    phi, lam = F.radians(F.col(lat) if isinstance(lat, str) else lat), F.radians(F.col(lon) if isinstance(lon, str) else lon)
    x, y, z = F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)
    p0, l0 = math.radians(lat0), math.radians(lon0)
    u = (-math.sin(l0)) * x + math.cos(l0) * y
    v = (-math.sin(p0) * math.cos(l0)) * x + (-math.sin(p0) * math.sin(l0)) * y + math.cos(p0) * z
    return u * R, v * R
