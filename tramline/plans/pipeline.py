"""The batch pipeline in stage order: Silver -> dims -> facts -> marts -> quality, each layer written as a table in the
shared warehouse folder and read back, so every stage starts from materialised data (short lineage, restartable per
stage).

``run_batch`` computes every date. ``run_incremental`` reads a manifest of the Bronze files that earlier runs have seen,
finds the service dates that new files reach, and replaces only these dates; its tables equal those of a full run.

What reaches a date: its own rows of every stream, and city events of other dates whose interval touches it. What spans
dates is kept apart or recomputed from stored tables: the average delay by route and stop (``gold/route_stop_avg``, one
scan of three Silver columns) is joined to the fact and the features when they are read; the weather and event marts and
the hotspots of the last 24 hours read a few columns of the stored facts, no join is done again."""
from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..operators import cleaning, dims, quality, staging
from ..params import DEFAULT_CITY, CityProfile
from ..session import materialise
from ..sources import folders
from ..sources.tables import read_layer, write_layer
from . import facts, marts

SILVER = ["transport_positions", "trip_updates", "weather_observations", "city_events"]
MANIFEST = "stream string, path string, modified timestamp, bytes long"
_HISTORY = "historical_avg_delay"


class Layers:
    """Tables of a warehouse folder; ``dates`` None: whole tables are replaced, else only these service dates."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.tables: dict[str, DataFrame] = {}

    def put(self, name: str, df: DataFrame, date_col: str | None = "event_ts", dates: list | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        dated = bool(date_col and date_col in df.columns)
        if dates is not None and dated:
            df = materialise(df, "dates")
            kept = {r[0] for r in df.select(F.to_date(date_col)).distinct().collect()}  # at most the given dates
            for d in dates:  # a date that has no row any more
                if d not in kept:
                    folders.delete(self.spark, f"{path}/service_date={d}")
        write_layer(df, path, date_col, keep_other_dates=dates is not None)
        fields = [f for f in df.schema.fields if f.name != "service_date"] if dated else df.schema.fields
        schema = StructType(fields + [StructField("service_date", DateType())] * dated)
        self.tables[name] = read_layer(self.spark, path, schema)
        return self.tables[name]

    def stored(self, name: str) -> DataFrame:
        return read_layer(self.spark, f"{self.root}/{name}")


def with_history(rows: DataFrame, averages: DataFrame) -> DataFrame:
    """Fact or feature rows with the average delay of their route at their stop, over all dates."""
    out = rows.join(averages, ["route_id", "stop_id"], "left")
    last = [c for c in ("service_date", "dbt_loaded_at") if c in out.columns]
    kept = [c for c in rows.columns if c not in last]
    return out.select(*kept, F.coalesce(_HISTORY, F.lit(0.0)).alias(_HISTORY), *last)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature table of a warehouse folder, or a table of complete features."""
    features, averages = read_layer(spark, path), f"{path.rstrip('/').rsplit('/', 1)[0]}/route_stop_avg"
    if _HISTORY not in features.columns and folders.complete(spark, averages):
        return with_history(features, read_layer(spark, averages))
    return features


def _dims(layers: Layers, gtfs: dict[str, DataFrame]) -> None:
    for name, make in (("stops", dims.dim_stops), ("routes", dims.dim_routes), ("trips", dims.dim_trips),
                       ("stop_times", dims.dim_stop_times)):
        layers.put(f"dims/{name}", make(gtfs[name]), None)


def _on(df: DataFrame, dates: list | None, date_col: str = "service_date") -> DataFrame:
    return df if dates is None else df.where(F.col(date_col).isin(dates))


def _delays(layers: Layers, silver: dict[str, DataFrame], dates: list | None, city: CityProfile) -> None:
    """Fact, features and marts by date of the trip delays."""
    tables = layers.tables
    weather = _on(layers.stored("staging/weather_hourly"), dates).drop("service_date")
    updates = staging.staged("trip_updates", _on(silver["trip_updates"], dates))
    events = staging.staged("city_events", silver["city_events"])
    if dates:  # what can be active on one of the dates
        events = events.where((F.col("end_time_utc") >= F.lit(min(dates))) & (F.col("start_time_utc") < F.lit(max(dates) + timedelta(days=1))))
    fact = facts.fct_trip_delays(updates, events, weather, tables["dims/stops"], tables["dims/trips"], tables["dims/routes"],
                                 tables["dims/stop_times"], stamp=True, city=city).drop(_HISTORY)
    fact = _on(layers.put("gold/fct_trip_delays", fact, dates=dates), dates)
    plain = fact.drop("service_date")
    layers.put("gold/ml_features", facts.ml_features(plain.withColumn(_HISTORY, F.lit(0.0))).drop(_HISTORY), dates=dates)
    layers.put("gold/mart_route_reliability", marts.route_reliability(plain), "service_date", dates)
    layers.put("gold/mart_delay_trends", marts.delay_trends(plain), "service_date", dates)


def _overall(layers: Layers) -> None:
    """Tables that span dates, from stored ones."""
    averages = layers.put("gold/route_stop_avg", facts.route_stop_avg(
        staging.staged("trip_updates", layers.stored("silver/trip_updates"))), None)
    fact = layers.stored("gold/fct_trip_delays").drop("service_date")
    layers.put("gold/mart_weather_impact", marts.weather_impact(fact), None)
    layers.put("gold/mart_events_impact", marts.events_impact(fact), None)
    for name in ("gold/fct_trip_delays", "gold/ml_features"):
        layers.tables[name] = with_history(layers.stored(name), averages)
    positions = layers.stored("gold/fct_vehicle_positions")
    newest = positions.select(F.max("service_date")).first()[0]
    if newest is not None:  # the last 24 hours lie on two dates
        layers.put("gold/mart_congestion_hotspots", marts.congestion_hotspots(
            positions.where(F.col("service_date") >= newest - timedelta(days=1)).drop("service_date")), None)


def _quality(layers: Layers, silver: dict[str, DataFrame]) -> None:
    results = None
    for table, rules in quality.silver_suites().items():
        if table in silver:
            r = quality.validate(silver[table].drop("service_date"), table, rules)
            results = r if results is None else results.unionByName(r)
    if results is not None:
        quality.append_runs(quality.summarize(results), f"{layers.root}/quality/quality_runs")


def run_batch(spark: SparkSession, bronze: dict[str, DataFrame], gtfs: dict[str, DataFrame], root: str,
              city: CityProfile = DEFAULT_CITY) -> dict:
    layers = Layers(spark, root)
    silver = {n: layers.put(f"silver/{n}", cleaning.clean(n, bronze[n], city)) for n in SILVER}
    _dims(layers, gtfs)
    weather = layers.put("staging/weather_hourly", staging.weather_hourly(silver["weather_observations"]), "obs_hour")
    layers.put("gold/fct_vehicle_positions", facts.fct_vehicle_positions(
        staging.staged("transport_positions", silver["transport_positions"]), weather.drop("service_date"), city=city))
    _delays(layers, silver, None, city)
    _overall(layers)
    _quality(layers, silver)
    return layers.tables


# ------------------------------------------------------------------ incremental runs
def bronze_files(spark: SparkSession, bronze_root: str) -> DataFrame:
    """The Bronze files of every stream, listed by Spark without reading them."""
    parts = [spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(f"{bronze_root}/{n}").select(F.lit(n).alias("stream"), "path", F.col("modificationTime").alias("modified"),
                                                F.col("length").alias("bytes"))
             for n in SILVER if folders.exists(spark, f"{bronze_root}/{n}")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _dates_of(rows: DataFrame, *columns) -> list:
    """Distinct dates between two times (or of one); what a run touches, so a few."""
    low, high = F.to_date(columns[0]), F.to_date(columns[-1])
    spans = rows.where(low.isNotNull() & (low <= high)).select(F.explode(F.sequence(low, high)).alias("d"))
    return [r[0] for r in spans.distinct().orderBy("d").collect()]


def run_incremental(spark: SparkSession, bronze_root: str, gtfs: dict[str, DataFrame], root: str,
                    city: CityProfile = DEFAULT_CITY) -> dict[str, list]:
    """Brings the warehouse up to date with the Bronze files that are new since the last run: the service dates replaced,
    by stream, and ``facts``. The first run reads everything. The manifest is written last, so a run that is lost midway
    is done again whole. The quality ledger gets the rows of the replaced dates. After a change of the network tables or
    of the city, start from an empty folder."""
    from ..streaming.bronze import good_rows
    layers = Layers(spark, root)
    manifest = f"{root}/manifest"
    files = materialise(bronze_files(spark, bronze_root), "listing")
    if folders.complete(spark, manifest):
        files = materialise(files.join(spark.read.schema(MANIFEST).parquet(manifest), ["stream", "path", "modified", "bytes"],
                                       "left_anti"), "new")
    new = {r.stream: r.paths for r in files.groupBy("stream").agg(F.collect_list("path").alias("paths")).collect()}
    if not new:  # paths: those of one run, since the cadence bounds them
        return {}
    touched: dict[str, list] = {}
    silver: dict[str, DataFrame] = {}
    reached: set = set()
    for n in SILVER:
        if n not in new and not folders.exists(spark, f"{root}/silver/{n}"):
            new[n] = []
        if n not in new:
            continue
        bronze = good_rows(read_layer(spark, f"{bronze_root}/{n}"))
        fresh = spark.read.schema(bronze.schema).parquet(*new[n]) if new[n] else bronze.limit(0)
        dates = touched[n] = _dates_of(fresh, "event_ts")
        undated = fresh.where("event_ts IS NULL").limit(1).count()
        of_dates = F.to_date("event_ts").isin(dates) | (F.col("event_ts").isNull() & F.lit(bool(undated)))
        raw = read_layer(spark, f"{bronze_root}/{n}")
        if "event_date" in raw.columns:  # the stream sink's partitions: others are not opened
            raw = raw.where(F.col("event_date").isin(dates) | (F.col("event_date").isNull() & F.lit(bool(undated))))
        clean = cleaning.clean(n, good_rows(raw).where(of_dates), city)
        if n == "city_events":  # intervals before and after the change
            if folders.exists(spark, f"{root}/silver/{n}"):
                reached.update(_dates_of(_on(layers.stored(f"silver/{n}"), dates), "start_time_utc", "end_time_utc"))
        silver[n] = _on(layers.put(f"silver/{n}", clean, dates=dates), dates)
        if n == "city_events":
            reached.update(_dates_of(silver[n], "start_time_utc", "end_time_utc"))
    _dims(layers, gtfs)
    wet = touched.get("weather_observations", [])
    if "weather_observations" in silver:
        layers.put("staging/weather_hourly", staging.weather_hourly(silver["weather_observations"]), "obs_hour", dates=wet)
    seen = sorted(set(touched.get("transport_positions", [])) | set(wet))
    if seen or not folders.exists(spark, f"{root}/gold/fct_vehicle_positions"):
        layers.put("gold/fct_vehicle_positions", facts.fct_vehicle_positions(
            staging.staged("transport_positions", _on(layers.stored("silver/transport_positions"), seen)),
            _on(layers.stored("staging/weather_hourly"), seen).drop("service_date"), city=city), dates=seen)
    held = {r[0] for r in layers.stored("silver/trip_updates").select("service_date").distinct().collect()}
    late = sorted((set(touched.get("trip_updates", [])) | set(wet) | reached) & held | set(touched.get("trip_updates", [])))
    if late or not folders.exists(spark, f"{root}/gold/fct_trip_delays"):
        _delays(layers, {n: layers.stored(f"silver/{n}") for n in ("trip_updates", "city_events")}, late, city)
    _overall(layers)
    _quality(layers, silver)
    files.write.mode("append").parquet(manifest)
    return touched | {"facts": late}
