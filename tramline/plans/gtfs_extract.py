"""Cut a city network out of a national GTFS feed: stops in a radius box,
then the stop times, trips and routes that reach them (semi-join chain),
with route modes derived from GTFS route types."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import city_bbox
from ..operators.dims import mode_from_route_type
from ..operators.joins import stop_segments, stops_in_order
from ..params import BBOX_RADIUS_KM, DEFAULT_CITY, CityProfile
from ..session import small_side


@dataclass
class CityNetwork:
    stops: DataFrame
    stop_times: DataFrame
    trips: DataFrame
    routes: DataFrame

    def counts(self) -> DataFrame:
        parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
                 for name, df in (("stops", self.stops), ("stop_times", self.stop_times),
                                  ("trips", self.trips), ("routes", self.routes))]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def require_stops(self) -> "CityNetwork":
        if self.stops.limit(1).count() == 0:
            raise RuntimeError("the radius box around the city holds no stop of the feed")
        return self


def stops_in_box(stops: DataFrame, city: CityProfile, radius_km: float) -> DataFrame:
    lat_d, lon_d = city_bbox(city.lat, radius_km)
    return stops.where(F.col("stop_lat").between(city.lat - lat_d, city.lat + lat_d)
                       & F.col("stop_lon").between(city.lon - lon_d, city.lon + lon_d))


def enrich_route_mode(city_routes: DataFrame, national_routes: DataFrame) -> DataFrame:
    """Mode from the national route_type by joining back on route_id; unknown -> bus."""
    types = national_routes.select("route_id", F.col("route_type").alias("_nat_type"))
    return city_routes.join(types, "route_id", "left") \
        .withColumn("route_mode", mode_from_route_type("_nat_type")).drop("_nat_type")


def extract_city(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, routes: DataFrame,
                 city: CityProfile = DEFAULT_CITY, radius_km: float = BBOX_RADIUS_KM) -> CityNetwork:
    city_stops = stops_in_box(stops, city, radius_km).select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", F.lit("").alias("stop_zone"))
    keys = city_stops.select("stop_id")
    city_st = stop_times.join(keys, "stop_id").select("trip_id", "stop_id", "stop_sequence", "arrival_time",
                                                      "departure_time")
    city_trips = trips.join(city_st.select("trip_id"), "trip_id", "left_semi").select(
        "trip_id", "route_id", "service_id", F.lit(0).alias("direction_id"), F.lit("").alias("trip_headsign"))
    city_routes = routes.join(city_trips.select("route_id"), "route_id", "left_semi").select(
        "route_id", "route_short_name", "route_long_name")
    return CityNetwork(city_stops, city_st, city_trips, enrich_route_mode(city_routes, routes))


def extract_city_in_place(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, city: CityProfile = DEFAULT_CITY,
                          radius_km: float = BBOX_RADIUS_KM) -> tuple[DataFrame, DataFrame]:
    """City stop times with the distance from the trip's stop before (also one outside the city), and city trips, from
    stop times and trips stored in the same buckets of trip_id: window and semi-join read the buckets where they lie, and
    the stops, a country's 600,000 at most in known feeds, go to them while their counted size allows it."""
    places = small_side(stops.select("stop_id", "stop_lat", "stop_lon"), 96)
    inside = small_side(stops_in_box(stops, city, radius_km).select("stop_id"), 64)
    segments = stop_segments(stop_times, places, ("arrival_time", "departure_time"))
    city_st = segments.join(inside, "stop_id", "left_semi")
    return city_st, trips.join(city_st.select("trip_id"), "trip_id", "left_semi")


def representative_trips(trips: DataFrame, stop_times: DataFrame, routes: DataFrame, min_stops: int = 2) -> DataFrame:
    """Per route the trip the simulator drives: the first direction-0 trip,
    else any trip (smallest id), if it has at least ``min_stops`` stops."""
    pick = trips.groupBy("route_id").agg(
        F.min(F.struct((~F.col("direction_id").eqNullSafe(F.lit(0))).alias("_d"), F.col("trip_id"))).alias("_p"))
    chosen = pick.select("route_id", F.col("_p.trip_id").alias("trip_id"))
    n = stop_times.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_stops"))
    out = chosen.join(n, "trip_id").where(F.col("n_stops") >= min_stops)
    return out.join(routes.select("route_id", "route_mode"), "route_id", "left")


def ordered_stops(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Stops of each trip in stop_sequence order with their position."""
    return stops_in_order(stop_times, stops).select("trip_id", "position", "stop_sequence", "stop_id", "stop_lat",
                                                    "stop_lon")


def route_lengths(rep: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Length of each representative trip: sum of consecutive stop distances."""
    seg = stop_segments(stop_times.join(rep.select("trip_id"), "trip_id", "left_semi"), stops)
    return rep.join(seg.groupBy("trip_id").agg(F.sum("segment_km").alias("length_km")), "trip_id", "left")
