"""The batch pipeline as one lazily-built graph of DataFrames.

Bronze (four streams) and GTFS tables go in; Silver, staging, dimensions,
facts and marts come out. Nothing is computed until an action; each layer can
be materialised with :func:`tramline.sources.tables.write_layer`.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning, dims, staging
from ..params import DEFAULT_CITY, CityProfile
from ..sources.fixtures import Fixture
from . import facts, marts


class Warehouse:
    def __init__(self, bronze: dict[str, DataFrame], gtfs: dict[str, DataFrame],
                 city: CityProfile = DEFAULT_CITY, stamp: bool = False):
        self.bronze, self.gtfs, self.city, self.stamp = bronze, gtfs, city, stamp

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        fx = Fixture(spark, sf_dir)
        bronze = {"transport_positions": fx.positions(), "trip_updates": fx.trip_updates(),
                  "weather_observations": fx.weather(), "city_events": fx.city_events()}
        gtfs = {"stops": fx.stops(), "routes": fx.routes(), "trips": fx.trips(), "stop_times": fx.stop_times()}
        wh = cls(bronze, gtfs, **kw)
        wh.fixture = fx
        return wh

    # ------------------------------------------------------------------ silver
    @cached_property
    def silver_positions(self):
        return cleaning.clean("transport_positions", self.bronze["transport_positions"], self.city, self.stamp)

    @cached_property
    def silver_trip_updates(self):
        return cleaning.clean("trip_updates", self.bronze["trip_updates"], self.city, self.stamp)

    @cached_property
    def silver_weather(self):
        return cleaning.clean("weather_observations", self.bronze["weather_observations"], self.city, self.stamp)

    @cached_property
    def silver_events(self):
        return cleaning.clean("city_events", self.bronze["city_events"], self.city, self.stamp)

    # ----------------------------------------------------------------- staging
    @cached_property
    def stg_positions(self):
        return staging.staged("transport_positions", self.silver_positions)

    @cached_property
    def stg_trip_updates(self):
        return staging.staged("trip_updates", self.silver_trip_updates)

    @cached_property
    def stg_weather(self):
        return staging.staged("weather_observations", self.silver_weather)

    @cached_property
    def stg_events(self):
        return staging.staged("city_events", self.silver_events)

    @cached_property
    def weather_hourly(self):
        return staging.weather_hourly(self.silver_weather)

    # -------------------------------------------------------------------- dims
    @cached_property
    def dim_stops(self):
        return dims.dim_stops(self.gtfs["stops"])

    @cached_property
    def dim_routes(self):
        return dims.dim_routes(self.gtfs["routes"])

    @cached_property
    def dim_trips(self):
        return dims.dim_trips(self.gtfs["trips"])

    @cached_property
    def dim_stop_times(self):
        return dims.dim_stop_times(self.gtfs["stop_times"])

    # ------------------------------------------------------------------- facts
    @cached_property
    def fct_trip_delays(self):
        return facts.fct_trip_delays(self.stg_trip_updates, self.stg_events, self.weather_hourly,
                                     self.dim_stops, self.dim_trips, self.dim_routes, self.dim_stop_times,
                                     city=self.city)

    @cached_property
    def fct_without_events(self):
        """The same fact for marts that read no event column: their plans hold no event search."""
        return facts.fct_trip_delays(self.stg_trip_updates, None, self.weather_hourly, self.dim_stops, self.dim_trips,
                                     self.dim_routes, self.dim_stop_times, city=self.city)

    @cached_property
    def fct_vehicle_positions(self):
        return facts.fct_vehicle_positions(self.stg_positions, self.weather_hourly, city=self.city)

    @cached_property
    def ml_features(self):
        return facts.ml_features(self.fct_trip_delays)

    # ------------------------------------------------------------------- marts
    @cached_property
    def mart_route_reliability(self):
        return marts.route_reliability(self.fct_without_events)

    @cached_property
    def mart_delay_trends(self):
        return marts.delay_trends(self.fct_without_events)

    @cached_property
    def mart_congestion_hotspots(self):
        return marts.congestion_hotspots(self.fct_vehicle_positions, marts.as_of_default(self.stg_positions))

    @cached_property
    def mart_weather_impact(self):
        return marts.weather_impact(self.fct_without_events)

    @cached_property
    def mart_events_impact(self):
        return marts.events_impact(self.fct_trip_delays)
