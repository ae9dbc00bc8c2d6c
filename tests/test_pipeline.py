"""Batch pipeline materialisation, partition pruning, SQL functions, city catalog."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tramline.functions.sql import register_sql_functions
from tramline.params import city_profile, load_city_catalog
from tramline.plans.pipeline import run_batch
from tramline.plans.warehouse import Warehouse

from .conftest import SF_SMALL


def test_run_batch_writes_every_layer_and_prunes_dates(spark):
    w = Warehouse.from_fixture(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="tramline-wh-")
    out = run_batch(spark, w.bronze, w.gtfs, root)
    assert out["gold/fct_trip_delays"].count() == w.fct_trip_delays.count()
    assert out["gold/mart_route_reliability"].count() == w.mart_route_reliability.count()
    assert spark.read.parquet(f"{root}/quality/quality_runs").count() == 4
    q = out["gold/fct_trip_delays"].where(F.col("service_date") == "2024-01-05")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_date" in plan
    assert q.count() == w.fct_trip_delays.where(F.to_date("event_ts") == "2024-01-05").count()


def _content(spark, root, name):
    """Rows of a table without run stamps, doubles rounded."""
    df = spark.read.parquet(f"{root}/{name}")
    return sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in df.select(
        *[c for c in sorted(df.columns) if c not in ("processed_ts", "dbt_loaded_at")]).collect())


def test_incremental_runs_equal_a_full_run(spark):
    """New files: a corrected trip update and one of a new date, an event whose interval reaches the next date, a weather
    correction. Only their dates are rewritten, and every table equals that of a full run over all files."""
    import datetime as dt
    from tramline.plans.pipeline import SILVER, read_features, run_incremental
    w = Warehouse.from_fixture(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="tramline-inc-")
    for n in SILVER:
        w.bronze[n].where("event_ts < '2024-01-09'").repartition(2).write.parquet(f"{root}/bronze/{n}")
    first = run_incremental(spark, f"{root}/bronze", w.gtfs, f"{root}/inc")
    assert len(first["facts"]) == 8 and run_incremental(spark, f"{root}/bronze", w.gtfs, f"{root}/inc") == {}

    def files(name, day):
        return sorted(os.listdir(f"{root}/inc/{name}/service_date=2024-01-{day:02}"))

    names = [f"silver/{n}" for n in SILVER] + ["staging/weather_hourly", "gold/fct_trip_delays", "gold/fct_vehicle_positions",
                                               "gold/ml_features", "gold/mart_route_reliability", "gold/mart_delay_trends"]
    before = {(n, d): files(n, d) for n in names for d in range(1, 9)}
    later = F.expr("ingested_ts + INTERVAL 2 HOURS")
    tu = w.bronze["trip_updates"]
    tu.where("event_ts >= '2024-01-03' AND event_ts < '2024-01-03 06:00:00'").withColumn(
        "delay_seconds", F.lit(777.0)).withColumn("ingested_ts", later).unionByName(
        tu.where("event_ts >= '2024-01-09' AND event_ts < '2024-01-10'")).write.mode("append").parquet(f"{root}/bronze/trip_updates")
    ev = w.bronze["city_events"].where("event_ts >= '2024-01-05' AND event_ts < '2024-01-06'").orderBy("event_ts").limit(3)
    ev.withColumns({"status": F.lit("ACTIVE"), "impact": F.lit(0.9), "lat": F.lit(52.45), "lon": F.lit(13.31), "ingested_ts": later,
                    "end_time_utc": F.lit(dt.datetime(2024, 1, 6, 9))}).write.mode("append").parquet(f"{root}/bronze/city_events")
    w.bronze["weather_observations"].where("event_ts >= '2024-01-07' AND event_ts < '2024-01-07 03:00:00'").withColumn(
        "temperature_c", F.lit(40.0)).withColumn("ingested_ts", later).write.mode("append").parquet(f"{root}/bronze/weather_observations")

    second = run_incremental(spark, f"{root}/bronze", w.gtfs, f"{root}/inc")
    day = lambda *ds: [dt.date(2024, 1, d) for d in ds]
    assert second == {"trip_updates": day(3, 9), "city_events": day(5), "weather_observations": day(7), "facts": day(3, 5, 6, 7, 9)}
    rewritten = {n: {d for d in range(1, 9) if files(n, d) != before[n, d]} for n in names}
    assert rewritten == {"silver/trip_updates": {3}, "silver/city_events": {5}, "silver/weather_observations": {7},
                         "silver/transport_positions": set(), "staging/weather_hourly": {7}, "gold/fct_vehicle_positions": {7},
                         **{f"gold/{n}": {3, 5, 6, 7} for n in ("fct_trip_delays", "ml_features", "mart_route_reliability", "mart_delay_trends")}}
    bronze = {n: spark.read.parquet(f"{root}/bronze/{n}") for n in SILVER}
    run_batch(spark, bronze, w.gtfs, f"{root}/full")
    for n in [*names, "gold/route_stop_avg", "gold/mart_weather_impact", "gold/mart_events_impact", "gold/mart_congestion_hotspots",
              "dims/stops"]:
        assert _content(spark, f"{root}/inc", n) == _content(spark, f"{root}/full", n), n
    features = read_features(spark, f"{root}/inc/gold/ml_features")
    assert features.where("historical_avg_delay <> 0").count() > 0


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT haversine_km(52.52, 13.405, 52.52, 13.505) AS km, weather_zone(52.52, 13.405) AS z, "
                  "delay_bucket(CAST(NULL AS DOUBLE)) AS b1, delay_bucket(121) AS b2").first()
    assert 6.7 < r["km"] < 6.8 and r["z"] == "Z22" and r["b1"] == "severe" and r["b2"] == "delayed"


def test_city_catalog(spark):
    path = os.path.join(tempfile.mkdtemp(), "cities.json")
    with open(path, "w") as f:
        json.dump([{"name": "Berlin", "lat": 52.52, "lon": 13.405}, {"name": "Köln", "lat": 50.9375, "lon": 6.9603}], f)
    cat = load_city_catalog(spark, path)
    koeln = city_profile(cat, "Köln")
    assert koeln.lat == 50.9375 and koeln.bounds["lat_min"] < 50.9375 < koeln.bounds["lat_max"]
    with pytest.raises(KeyError):
        city_profile(cat, "Atlantis")


def test_sizing_conf():
    from tramline.session import sizing_conf
    c = sizing_conf(100 * 1024 ** 4, executor_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (128 * 1024 ** 2)
    assert int(sizing_conf(1024, 8)["spark.sql.shuffle.partitions"]) == 16
