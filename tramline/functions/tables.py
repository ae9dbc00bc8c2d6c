"""The read queries as SQL table functions: ``SELECT * FROM top_routes(10)``, or with bound parameters
``spark.sql("SELECT * FROM top_routes(:n)", args={"n": 10})``. They are SQL bodies over temporary views of the marts, so
they inline into the caller's plan. Lists carry their ``position``, so that their order survives any further query."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name -> (parameters, view, columns, order): what a list shows and how it is ordered.
LISTS = {
    "top_routes": ("n INT", "mart_route_reliability",
                   "route_id STRING, route_mode STRING, service_date DATE, avg_delay_seconds DOUBLE, p95_delay_seconds DOUBLE, "
                   "on_time_pct DOUBLE, severe_pct DOUBLE, stops_observed BIGINT", "avg_delay_seconds DESC, route_id, service_date"),
    "latest_trends": ("n INT", "mart_delay_trends",
                      "service_date DATE, hour_of_day INT, observations BIGINT, avg_delay_seconds DOUBLE, on_time_pct DOUBLE, "
                      "severe_pct DOUBLE", "service_date DESC, hour_of_day DESC"),
    "top_hotspots": ("n INT", "mart_congestion_hotspots",
                     "grid_cell STRING, avg_delay_seconds DOUBLE, avg_speed_kmh DOUBLE, avg_congestion DOUBLE, vehicles BIGINT, "
                     "severe_pct DOUBLE, congestion_rank BIGINT", "congestion_rank"),
    "reliability_listing": ("", "mart_route_reliability",
                            "route_id STRING, route_mode STRING, service_date DATE, trips BIGINT, stops_observed BIGINT, on_time_pct DOUBLE, "
                            "reliability_score DOUBLE, avg_delay_seconds DOUBLE, p95_delay_seconds DOUBLE",
                            "service_date DESC, reliability_score, route_id"),
    "weather_impact_listing": ("", "mart_weather_impact",
                               "condition STRING, precip_bucket STRING, temp_bucket STRING, observations BIGINT, avg_delay_seconds DOUBLE, "
                               "p95_delay_seconds DOUBLE, on_time_pct DOUBLE, severe_pct DOUBLE",
                               "avg_delay_seconds DESC, condition, precip_bucket, temp_bucket"),
    "events_impact_listing": ("", "mart_events_impact",
                              "proximity_bucket STRING, observations BIGINT, avg_delay_seconds DOUBLE, p95_delay_seconds DOUBLE, "
                              "on_time_pct DOUBLE, avg_event_impact DOUBLE", "avg_delay_seconds DESC, proximity_bucket"),
}


def _names(columns: str) -> str:
    return ", ".join(c.split()[0] for c in columns.split(", "))


def register_lists(spark: SparkSession, marts: dict[str, DataFrame], names: list[str] | None = None) -> None:
    """Views of the marts and the table functions over them. The position is a row number over a mart, whose size is that
    of routes and dates; with a limit each task keeps its first n rows before they meet."""
    for name in names or LISTS:
        parameters, view, columns, order = LISTS[name]
        marts[view].createOrReplaceTempView(view)
        limit = "WHERE position <= n" if parameters else ""
        spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE (position INT, {columns}) RETURN
  SELECT position, {_names(columns)} FROM (
    SELECT row_number() OVER (ORDER BY {order}) AS position, {_names(columns)} FROM {view}) {limit}""")


def register_city_functions(spark: SparkSession, catalog: DataFrame, positions: DataFrame) -> None:
    """city_bounds(name, radius_km): a city's box from the catalog (name, lat, lon); positions_of_city(name, radius_km):
    the positions inside it. An unknown city has no bounds and no positions."""
    catalog.select("name", "lat", "lon").createOrReplaceTempView("city_catalog")
    positions.createOrReplaceTempView("transport_positions")
    spark.sql("""
CREATE OR REPLACE TEMPORARY FUNCTION city_bounds(city STRING, radius_km DOUBLE)
RETURNS TABLE (lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE) RETURN
  SELECT lat - radius_km / 111.0D, lat + radius_km / 111.0D,
         lon - radius_km / (111.0D * greatest(cos(radians(lat)), 0.2D)),
         lon + radius_km / (111.0D * greatest(cos(radians(lat)), 0.2D))
  FROM city_catalog WHERE name = city""")
    spark.sql("""
CREATE OR REPLACE TEMPORARY FUNCTION positions_of_city(city STRING, radius_km DOUBLE)
RETURNS TABLE (vehicle_id STRING, route_id STRING, lat DOUBLE, lon DOUBLE, event_ts TIMESTAMP) RETURN
  SELECT p.vehicle_id, p.route_id, p.lat, p.lon, p.event_ts FROM transport_positions p
  JOIN city_bounds(city, radius_km) b
    ON p.lat BETWEEN b.lat_min AND b.lat_max AND p.lon BETWEEN b.lon_min AND b.lon_max""")
