"""The command-line jobs chained: GTFS text -> typed tables, Bronze -> all layers."""
import os
import tempfile

from tramline import jobs
from tramline.sources.fixtures import Fixture
from tramline.sources.gtfs import export_sorted_csv

from .conftest import SF_SMALL


def test_gtfs_load_and_batch_jobs(spark):
    fx = Fixture(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="tramline-jobs-")
    gt = f"{root}/gtfs_txt"
    os.makedirs(gt)
    export_sorted_csv(fx.stops(), f"{gt}/stops.txt", ["stop_id"], 2)
    export_sorted_csv(fx.routes().select("route_id", "route_mode", "route_short_name", "route_long_name"),
                      f"{gt}/routes.txt", ["route_id"], 1)
    export_sorted_csv(fx.trips(), f"{gt}/trips.txt", ["trip_id"], 2)
    export_sorted_csv(fx.stop_times(), f"{gt}/stop_times.txt", ["trip_id", "stop_sequence"], 2)
    assert jobs.main(["gtfs-load", "--gtfs-dir", gt, "--out", root]) == 0
    routes = spark.read.parquet(f"{root}/gtfs/routes")
    assert routes.where("agency_id = 'DE' AND route_type IS NOT NULL").count() == 25
    bronze = f"{root}/bronze"
    for name, df in {"transport_positions": fx.positions(), "trip_updates": fx.trip_updates(),
                     "weather_observations": fx.weather(), "city_events": fx.city_events()}.items():
        df.write.parquet(f"{bronze}/{name}")
    # the fixture has updates without a delay, so the quality gate closes
    assert jobs.main(["batch", "--bronze", bronze, "--gtfs", f"{root}/gtfs", "--out", f"{root}/wh"]) == 1
    assert spark.read.parquet(f"{root}/wh/gold/mart_route_reliability").count() > 0
    assert spark.read.parquet(f"{root}/wh/quality/quality_runs").count() == 4


def test_batch_of_another_city_and_open_quality_gate(spark):
    import json
    fx = Fixture(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="tramline-jobs-")
    cities = f"{root}/cities.json"
    with open(cities, "w") as f:
        json.dump([{"name": "Berlin", "lat": 52.52, "lon": 13.405}, {"name": "Lisboa", "lat": 38.72, "lon": -9.14}], f)
    moved = fx.positions().where("lon is not null").selectExpr(
        "* except (lat, lon, speed_kmh)", "lat - 13.8 as lat", "lon - 22.5 as lon", "least(speed_kmh, 100.0) as speed_kmh")
    bronze = {"transport_positions": moved, "weather_observations": fx.weather(), "city_events": fx.city_events(),
              "trip_updates": fx.trip_updates().where("delay_seconds is not null")}
    for name, df in bronze.items():
        df.write.parquet(f"{root}/bronze/{name}")
    for name, df in {"stops": fx.stops(), "routes": fx.routes(), "trips": fx.trips(), "stop_times": fx.stop_times()}.items():
        df.write.parquet(f"{root}/gtfs/{name}")
    run = ["batch", "--bronze", f"{root}/bronze", "--gtfs", f"{root}/gtfs", "--cities", cities]
    assert jobs.main([*run, "--out", f"{root}/lisboa", "--city", "Lisboa"]) in (0, 1)
    assert spark.read.parquet(f"{root}/lisboa/silver/transport_positions").count() > 0
    facts = spark.read.parquet(f"{root}/lisboa/gold/fct_vehicle_positions")
    assert facts.count() > 0


def test_city_extraction_and_scoring_jobs(spark):
    import pytest
    fx = Fixture(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="tramline-jobs-")
    gt = f"{root}/national"
    os.makedirs(gt)
    export_sorted_csv(fx.stops(), f"{gt}/stops.txt", ["stop_id"], 1)
    export_sorted_csv(fx.routes().drop("route_mode"), f"{gt}/routes.txt", ["route_id"], 1)
    export_sorted_csv(fx.trips(), f"{gt}/trips.txt", ["trip_id"], 1)
    export_sorted_csv(fx.stop_times(), f"{gt}/stop_times.txt", ["trip_id", "stop_sequence"], 1)
    assert jobs.main(["city", "--gtfs-dir", gt, "--out", f"{root}/city", "--radius-km", "5"]) == 0
    counts = {r["table_name"]: r["rows"] for r in spark.read.json(f"{root}/city/counts").collect()}
    assert 0 < counts["stops"] < fx.stops().count()
    modes = spark.read.option("header", True).csv(f"{root}/city/routes.txt")
    assert modes.count() == counts["routes"] and "route_mode" in modes.columns
    with pytest.raises(RuntimeError):
        jobs.main(["city", "--gtfs-dir", gt, "--out", f"{root}/none", "--radius-km", "0.001"])

    from tramline.plans.warehouse import Warehouse
    features = Warehouse.from_fixture(spark, SF_SMALL).ml_features
    features.write.parquet(f"{root}/features")
    assert jobs.main(["train", "--features", f"{root}/features", "--model-dir", f"{root}/model", "--trees", "2"]) == 0
    assert jobs.main(["score", "--features", f"{root}/features", "--model-dir", f"{root}/model", "--out", f"{root}/scores"]) == 0
    scores = spark.read.parquet(f"{root}/scores")
    assert scores.count() == features.count() and scores.where("predicted_delay_seconds is null").count() == 0
