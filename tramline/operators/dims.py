"""GTFS typed projections and dimensions."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..params import ROUTE_MODE_BY_TYPE, ROUTE_TYPE_BY_MODE, AGENCY_ID


def typed_stops(raw: DataFrame) -> DataFrame:
    return raw.select("stop_id", "stop_name", F.col("stop_lat").try_cast("double").alias("stop_lat"),
                      F.col("stop_lon").try_cast("double").alias("stop_lon"), "stop_zone")


def typed_routes(raw: DataFrame) -> DataFrame:
    return raw.select("route_id", "agency_id", "route_short_name", "route_long_name",
                      F.col("route_type").try_cast("int").alias("route_type"), "route_mode")


def typed_trips(raw: DataFrame) -> DataFrame:
    return raw.select("trip_id", "route_id", "service_id",
                      F.col("direction_id").try_cast("int").alias("direction_id"), "trip_headsign")


def typed_stop_times(raw: DataFrame) -> DataFrame:
    # arrival/departure stay text: GTFS clock times may pass 24:00
    return raw.select("trip_id", "stop_id", F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
                      "arrival_time", "departure_time")


def stop_zone_num(zone) -> F.Column:
    z = F.col(zone) if isinstance(zone, str) else zone
    return F.when(z.rlike("^Z[0-9]+$"), F.regexp_replace(z, "Z", "").try_cast("int"))


def dim_stops(stops: DataFrame) -> DataFrame:
    return stops.select("stop_id", "stop_name", "stop_lat", "stop_lon", "stop_zone",
                        stop_zone_num("stop_zone").alias("stop_zone_num"))


def dim_routes(routes: DataFrame) -> DataFrame:
    return routes.select("route_id", "agency_id", "route_short_name", "route_long_name", "route_type", "route_mode")


def dim_trips(trips: DataFrame) -> DataFrame:
    return trips.select("trip_id", "route_id", "service_id", "direction_id", "trip_headsign")


def dim_stop_times(st: DataFrame) -> DataFrame:
    return st.select("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time")


def _literal_map(mapping: dict):
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


def assign_route_type(routes_raw: DataFrame, mapping: dict = ROUTE_TYPE_BY_MODE,
                      agency: str = AGENCY_ID) -> DataFrame:
    """Loader rule: constant agency, route_type looked up from route_mode."""
    return (routes_raw.withColumn("agency_id", F.lit(agency))
            .withColumn("route_type", _literal_map(mapping)[F.col("route_mode")].cast("int")))


def mode_from_route_type(route_type, mapping: dict = ROUTE_MODE_BY_TYPE, default: str = "bus") -> F.Column:
    """GTFS route_type (standard + extended codes) -> rail/tram/bus, default bus."""
    rt = F.col(route_type) if isinstance(route_type, str) else route_type
    return F.coalesce(_literal_map(mapping)[rt.try_cast("int")], F.lit(default))
