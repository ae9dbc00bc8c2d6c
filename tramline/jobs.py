"""Command-line jobs (``python -m tramline.jobs <job> ...`` or spark-submit):

  ingest     stream the four topics / file feeds to Bronze (+ quarantine)
  gtfs-load  GTFS text files -> typed GTFS tables (route_type from route_mode)
  batch      Bronze + GTFS tables -> Silver, dims, facts, marts, quality ledger
  city       national GTFS text files -> the city's network as sorted CSV with route modes
  train      feature table -> delay models, metrics, feature contract
  score      saved models + feature rows -> predicted delays

``batch`` exits with 1 when a quality rule of a Silver table fails.

Paths are folders of a shared file system; the SparkSession comes from the
submitting environment (master, checkpoint folder, resources).
"""
from __future__ import annotations

import argparse
import sys

from .session import build_session, checkpoint_dir


def _ingest(spark, a):
    from .streaming import bronze as B
    src = B.Source(kind=a.source, path=a.feed, bootstrap=a.bootstrap, max_files_per_trigger=a.max_files)
    trigger = {"availableNow": True} if a.once else {"processingTime": a.trigger}
    qs = B.start_all(spark, src, a.out, a.checkpoints or f"{checkpoint_dir(spark)}/ingest", trigger)
    B.await_all(spark, qs)


def _gtfs_load(spark, a):
    from .operators import dims
    from .sources.gtfs import GTFS_COLUMNS, read_gtfs_table
    from .sources.tables import write_layer
    typed = {"stops": dims.typed_stops, "trips": dims.typed_trips, "stop_times": dims.typed_stop_times}
    for name, cols in GTFS_COLUMNS.items():
        df = read_gtfs_table(spark, a.gtfs_dir, name, cols)
        if name == "routes":
            df = dims.typed_routes(dims.assign_route_type(df).select(
                "route_id", "agency_id", "route_short_name", "route_long_name", "route_type", "route_mode"))
        else:
            df = typed[name](df)
        write_layer(df, f"{a.out}/gtfs/{name}", None)


def _city_profile(spark, a):
    from .params import DEFAULT_CITY, city_profile, load_city_catalog
    return city_profile(load_city_catalog(spark, a.cities), a.city) if a.city else DEFAULT_CITY


def _batch(spark, a):
    from .operators import quality
    from .plans.pipeline import SILVER, run_batch, run_incremental
    from .sources.tables import read_layer
    from .streaming.bronze import good_rows
    gtfs = {n: read_layer(spark, f"{a.gtfs}/{n}") for n in ("stops", "routes", "trips", "stop_times")}
    if a.incremental:
        if not run_incremental(spark, a.bronze, gtfs, a.out, _city_profile(spark, a)):
            return 0  # nothing new
    else:
        bronze = {n: good_rows(read_layer(spark, f"{a.bronze}/{n}")) for n in SILVER}
        run_batch(spark, bronze, gtfs, a.out, _city_profile(spark, a))
    runs = spark.read.parquet(f"{a.out}/quality/quality_runs")
    newest = runs.where(runs["run_at_utc"] == runs.selectExpr("max(run_at_utc)").scalar())
    return 0 if quality.overall(newest).first()["all_passed"] else 1


def _city(spark, a):
    from .operators import dims
    from .plans.gtfs_extract import extract_city
    from .sources.gtfs import export_sorted_csv, read_gtfs_table
    columns = {"stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "stop_zone"],
               "stop_times": ["trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"],
               "trips": ["trip_id", "route_id", "service_id", "direction_id", "trip_headsign"],
               "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type", "route_mode"]}
    raw = {n: read_gtfs_table(spark, a.gtfs_dir, n, c) for n, c in columns.items()}
    net = extract_city(dims.typed_stops(raw["stops"]), dims.typed_stop_times(raw["stop_times"]),
                       dims.typed_trips(raw["trips"]), dims.typed_routes(raw["routes"]), _city_profile(spark, a),
                       a.radius_km).require_stops()
    for name, df, order in (("stops", net.stops, ["stop_id"]), ("routes", net.routes, ["route_id"]),
                            ("trips", net.trips, ["trip_id"]), ("stop_times", net.stop_times, ["trip_id", "stop_sequence"])):
        export_sorted_csv(df, f"{a.out}/{name}.txt", order)
    net.counts().write.mode("overwrite").json(f"{a.out}/counts")


def _score(spark, a):
    from .plans import ml
    from .plans.pipeline import read_features
    ml.score(ml.load(a.model_dir), read_features(spark, a.features)).write.mode("overwrite").parquet(a.out)


def _train(spark, a):
    from .plans import ml
    from .plans.pipeline import read_features
    feats = read_features(spark, a.features)
    models, test = ml.train(feats, ml.ModelParams(n_estimators=a.trees))
    ml.save(models, a.model_dir, ml.metrics(models, test))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tramline.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--source", choices=["files", "kafka"], default="files")
    i.add_argument("--feed"), i.add_argument("--bootstrap"), i.add_argument("--max-files", type=int)
    i.add_argument("--out", required=True), i.add_argument("--checkpoints")
    i.add_argument("--trigger", default="10 seconds"), i.add_argument("--once", action="store_true")
    g = sub.add_parser("gtfs-load")
    g.add_argument("--gtfs-dir", required=True), g.add_argument("--out", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--bronze", required=True), b.add_argument("--gtfs", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--incremental", action="store_true", help="only the dates that new Bronze files reach")
    c = sub.add_parser("city")
    c.add_argument("--gtfs-dir", required=True), c.add_argument("--out", required=True)
    c.add_argument("--radius-km", type=float, default=25.0)
    for x in (b, c):
        x.add_argument("--city", help="name in the city catalog (default: Berlin)")
        x.add_argument("--cities", help="JSON city catalog")
    t = sub.add_parser("train")
    t.add_argument("--features", required=True), t.add_argument("--model-dir", required=True)
    t.add_argument("--trees", type=int, default=300)
    p = sub.add_parser("score")
    p.add_argument("--features", required=True), p.add_argument("--model-dir", required=True)
    p.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = build_session(f"tramline-{a.job}")
    run = {"ingest": _ingest, "gtfs-load": _gtfs_load, "batch": _batch, "city": _city, "train": _train, "score": _score}
    return run[a.job](spark, a) or 0


if __name__ == "__main__":
    sys.exit(main())
