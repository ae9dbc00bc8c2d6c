"""GTFS static files: header CSV read as text, typed later by try_cast projections, and sorted CSV export."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

GTFS_COLUMNS = {
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "stop_zone"],
    "routes": ["route_id", "route_mode", "route_short_name", "route_long_name"],
    "trips": ["trip_id", "route_id", "service_id", "direction_id", "trip_headsign"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"],
}


def read_gtfs_table(spark: SparkSession, gtfs_dir: str, name: str, columns=None) -> DataFrame:
    """``<dir>/<name>.txt`` by its header: every column read as text (no inference pass), the wanted ones selected
    by name in any order, optional ones that the feed lacks as NULL, extra ones ignored."""
    df = spark.read.option("header", True).option("delimiter", ",").option("inferSchema", False).csv(
        f"{gtfs_dir}/{name}.txt")
    if columns is None:
        return df
    known = {c.strip("\ufeff ").lower(): c for c in df.columns}
    return df.select(*[F.col(f"`{known[c]}`").alias(c) if c in known else F.lit(None).cast("string").alias(c)
                       for c in columns])


def export_sorted_csv(df: DataFrame, path: str, order: list[str], partitions: int | None = None) -> None:
    """Globally sorted CSV with header: range-partitioned on the sort key so
    part files concatenate in order, no single-file funnel."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
       .write.mode("overwrite").option("header", True).csv(path))
