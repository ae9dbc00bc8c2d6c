"""GTFS text files: header CSV round trip, typed projections, city extraction."""
import tempfile

import pytest

from tramline.operators import dims
from tramline.params import CityProfile
from tramline.plans.gtfs_extract import extract_city
from tramline.sources.fixtures import Fixture
from tramline.sources.gtfs import GTFS_COLUMNS, export_sorted_csv, read_gtfs_table

from .conftest import SF_SMALL


def test_csv_round_trip_and_typed_projection(spark):
    fx = Fixture(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="tramline-gtfs-")
    stops = fx.stops()
    export_sorted_csv(stops, f"{root}/stops.txt", ["stop_id"], partitions=3)
    back = dims.typed_stops(read_gtfs_table(spark, root, "stops", GTFS_COLUMNS["stops"]))
    norm = lambda df: sorted((r["stop_id"], round(r["stop_lat"], 9), round(r["stop_lon"], 9), r["stop_zone"] or "")
                             for r in df.collect())
    assert norm(back) == norm(stops)
    import glob
    ids = []
    for part in sorted(glob.glob(f"{root}/stops.txt/part-*")):
        with open(part) as f:
            ids += [line.split(",")[0] for line in f.read().splitlines()[1:]]
    assert ids == sorted(ids) and len(ids) == stops.count()  # part files concatenate in global order


def test_extraction_needs_stops(spark):
    fx = Fixture(spark, SF_SMALL)
    far = CityProfile(name="Nowhere", lat=10.0, lon=10.0)
    net = extract_city(fx.stops(), fx.stop_times(), fx.trips(), fx.routes(), far, 25.0)
    with pytest.raises(RuntimeError):
        net.require_stops()


def test_extraction_chain_is_consistent(spark):
    fx = Fixture(spark, SF_SMALL)
    net = extract_city(fx.stops(), fx.stop_times(), fx.trips(), fx.routes(), radius_km=5.0).require_stops()
    stop_ids = {r[0] for r in net.stops.select("stop_id").collect()}
    assert {r[0] for r in net.stop_times.select("stop_id").distinct().collect()} <= stop_ids
    trips = {r[0] for r in net.trips.select("trip_id").collect()}
    assert trips == {r[0] for r in net.stop_times.select("trip_id").distinct().collect()}
    assert {r[0] for r in net.routes.select("route_mode").distinct().collect()} <= {"rail", "tram", "bus"}


def test_header_decides_columns(spark):  # S10
    import os
    root = tempfile.mkdtemp(prefix="tramline-gtfs-")
    with open(os.path.join(root, "stops.txt"), "w") as f:
        f.write("stop_lon,stop_desc,stop_id,stop_lat,stop_name\n13.4,x,S1,52.5,One\n")
    r = read_gtfs_table(spark, root, "stops", GTFS_COLUMNS["stops"]).first()
    assert tuple(r) == ("S1", "One", "52.5", "13.4", None)
