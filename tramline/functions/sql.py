"""The geo and bucket helpers as Spark SQL temporary functions, for users
who write SQL (``SELECT haversine_km(...), delay_bucket(...)``). They are SQL
function bodies, so they inline into the plan like built-ins (no Python)."""
from __future__ import annotations

from pyspark.sql import SparkSession

from ..params import CITY_LAT, CITY_LON, DEFAULT_THRESHOLDS, EARTH_RADIUS_KM, WEATHER_GRID_DEG


def register_sql_functions(spark: SparkSession, city_lat: float = CITY_LAT, city_lon: float = CITY_LON) -> None:
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
RETURNS DOUBLE RETURN
  asin(sqrt(pow(sin(radians((lat2 - lat1) / 2.0)), 2)
            + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2.0)), 2))) * 2 * {EARTH_RADIUS_KM}""")
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION weather_zone(lat DOUBLE, lon DOUBLE)
RETURNS STRING RETURN
  concat('Z', cast(cast(rint((lat - {city_lat}) / {WEATHER_GRID_DEG}) + 2 AS INT) AS STRING),
              cast(cast(rint((lon - {city_lon}) / {WEATHER_GRID_DEG}) + 2 AS INT) AS STRING))""")
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION delay_bucket(d DOUBLE)
RETURNS STRING RETURN
  CASE WHEN d <= {DEFAULT_THRESHOLDS.on_time} THEN 'on_time'
       WHEN d <= {DEFAULT_THRESHOLDS.severe} THEN 'delayed' ELSE 'severe' END""")
