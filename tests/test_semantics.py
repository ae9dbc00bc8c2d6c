"""Hand-made edge frames for the semantic traps of the reference models."""
import datetime as dt

import pytest
from pyspark.sql import Row, functions as F

from tramline.functions import buckets as B, geo as G, timefn as T
from tramline.operators import cleaning, dedup, dims, staging
from tramline.operators.joins import stop_segments
from tramline.operators.nearest import nearest_active_event
from tramline.plans import marts

from .helpers import rows

TS = dt.datetime(2024, 1, 7, 8, 30)  # a Sunday


def test_delay_bucket_null_is_severe(spark):  # T3
    df = spark.createDataFrame([(None,), (120.0,), (120.5,), (600.0,), (601.0,)], "d double")
    got = [r[0] for r in df.select(B.delay_bucket("d")).collect()]
    assert got == ["severe", "on_time", "delayed", "delayed", "severe"]


def test_null_speed_makes_row_invalid_and_dropped(spark):  # T4
    bronze = spark.createDataFrame([
        Row(vehicle_id="V1", route_id="R1", route_mode="bus", trip_id="T1", direction_id=0, stop_id="S1",
            next_stop_id="S2", lat=52.5, lon=13.4, speed_kmh=None, heading_deg=0.0, delay_seconds=None,
            congestion_level=0.1, event_ts=TS, ingested_ts=TS)],
        "vehicle_id string, route_id string, route_mode string, trip_id string, direction_id int, stop_id string, "
        "next_stop_id string, lat double, lon double, speed_kmh double, heading_deg double, delay_seconds double, "
        "congestion_level double, event_ts timestamp, ingested_ts timestamp")
    silver = cleaning.clean("transport_positions", bronze, stamp=False)
    r = rows(silver)[0]
    assert r["dqr_speed_anomaly"] is None and r["dqr_valid"] is None
    assert r["delay_seconds"] == 0.0  # NULL delay repaired to 0
    assert staging.staged("transport_positions", silver).count() == 0


def test_dedup_is_deterministic(spark):  # T5
    df = spark.createDataFrame([("k", TS, TS, "a"), ("k", TS, TS, "b"),
                                ("k", TS, TS - dt.timedelta(seconds=1), "z")],
                               "key string, event_ts timestamp, ingested_ts timestamp, payload string")
    for parts in (1, 3):
        got = rows(dedup.dedup_latest(df.repartition(parts), ["key", "event_ts"]))
        assert got == [{"key": "k", "event_ts": TS, "ingested_ts": TS, "payload": "b"}]


def test_minute_precision_timestamps_parse(spark):  # T2
    from tramline.schemas import CITY_EVENTS
    from tramline.sources.streams import decode_json
    msgs = spark.createDataFrame([('{"event_id": "E1", "start_time_utc": "2024-01-01T10:05+00:00", '
                                   '"end_time_utc": "2024-01-01T12:05:30+00:00", "lat": 52.5, "lon": 13.4}',),
                                  ("not json at all",)], "value string")
    out = rows(decode_json(msgs, CITY_EVENTS))
    assert out[0]["start_time_utc"] == dt.datetime(2024, 1, 1, 10, 5)
    assert out[0]["end_time_utc"] == dt.datetime(2024, 1, 1, 12, 5, 30)
    assert out[0]["_corrupt_record"] is None
    assert out[1]["_corrupt_record"] == "not json at all" and out[1]["event_id"] is None  # T19


def _events(spark, evs):
    return spark.createDataFrame(evs, "event_id string, lat double, lon double, start_time_utc timestamp, "
                                      "end_time_utc timestamp, impact double, status string")


def test_nearest_event_ties_go_to_smaller_id(spark):  # T7
    pts = spark.createDataFrame([("T1", "S1", TS, 52.5, 13.4)],
                                "trip_id string, stop_id string, event_ts timestamp, stop_lat double, stop_lon double")
    start, end = TS - dt.timedelta(hours=5), TS + dt.timedelta(hours=1)
    ev = _events(spark, [("EV-9", 52.51, 13.4, start, end, 0.9, "ACTIVE"),
                         ("EV-10", 52.49, 13.4, start, end, 0.1, "ACTIVE"),      # same distance
                         ("EV-10", 52.49, 13.4, start, end, 0.1, "ACTIVE"),      # re-emitted copy
                         ("EV-1", 52.5, 13.4, start, end, 0.5, "ENDED"),         # not active
                         ("EV-2", 52.5, 13.4, TS + dt.timedelta(minutes=1), end, 0.5, "ACTIVE")])  # not yet
    got = rows(nearest_active_event(pts, ev, ["trip_id", "stop_id", "event_ts"]))
    assert len(got) == 1 and got[0]["nearest_event_id"] == "EV-10" and got[0]["nearest_impact"] == 0.1


def test_events_impact_has_no_no_event_bucket(spark):  # T8
    fact = spark.createDataFrame([(10.0, 30.0, "on_time", 0.0), (0.5, 700.0, "severe", 0.4)],
                                 "event_proximity_km double, delay_seconds double, delay_bucket string, "
                                 "nearest_event_impact double")
    got = {r["proximity_bucket"] for r in marts.events_impact(fact).collect()}
    assert got == {"far", "inside_1km"}


def test_grid_cell_keeps_trailing_zeros(spark):  # T10
    df = spark.createDataFrame([(52.5, 13.4)], "lat double, lon double")
    assert df.select(G.grid_cell("lat", "lon")).first()[0] == "52.50|13.40"


def test_zone_rounds_half_to_even_and_out_of_grid(spark):  # T12, T13
    # (lat - 52.52) / 0.03 = 0.5 exactly is not representable; use a centre at 0 to hit ties
    df = spark.createDataFrame([(0.015, 0.045), (5.0, 0.0)], "lat double, lon double")
    got = [r[0] for r in df.select(G.weather_zone("lat", "lon", 0.0, 0.0)).collect()]
    assert got[0] == "Z24"  # rint(0.5)=0 -> 2, rint(1.5)=2 -> 4
    assert got[1] == "Z1692"  # far outside the 0..4 grid: an id no weather zone has


def test_day_of_week_sunday_is_zero(spark):  # T14
    df = spark.createDataFrame([(TS,)], "ts timestamp")
    r = df.select(T.day_of_week("ts"), T.hour_of_day("ts"), T.is_rush_hour("ts")).first()
    assert tuple(r) == (0, 8, 1)


def test_segment_fan_out_when_trip_revisits_stop(spark):  # T16
    st = spark.createDataFrame([("T1", "A", 1), ("T1", "B", 2), ("T1", "A", 3)],
                               "trip_id string, stop_id string, stop_sequence int")
    stops = spark.createDataFrame([("A", 52.5, 13.4), ("B", 52.51, 13.4)], "stop_id string, stop_lat double, stop_lon double")
    seg = stop_segments(st, stops)
    a = seg.where("stop_id = 'A'").orderBy("stop_sequence").collect()
    assert [r["segment_km"] for r in a][0] == 0.0 and a[1]["segment_km"] > 1.0
    # joining updates on (trip, stop) therefore yields two rows for a stop-A update
    tu = spark.createDataFrame([("T1", "A")], "trip_id string, stop_id string")
    assert tu.join(seg, ["trip_id", "stop_id"], "left").count() == 2


def test_try_cast_on_bad_gtfs_text(spark):  # T20
    raw = spark.createDataFrame([("R1", "DE", "1", "One", "x3", "bus")],
                                "route_id string, agency_id string, route_short_name string, route_long_name string, "
                                "route_type string, route_mode string")
    assert dims.typed_routes(raw).first()["route_type"] is None


def test_stop_zone_number(spark):
    df = spark.createDataFrame([("Z3",), ("",), ("Zx",), (None,), ("Z12",)], "stop_zone string")
    assert [r[0] for r in df.select(dims.stop_zone_num("stop_zone")).collect()] == [3, None, None, None, 12]


def test_route_mode_from_type(spark):
    df = spark.createDataFrame([("0",), ("2",), ("109",), ("715",), ("1400",), ("abc",), (None,), ("99",)], "t string")
    got = [r[0] for r in df.select(dims.mode_from_route_type("t")).collect()]
    assert got == ["tram", "rail", "rail", "bus", "tram", "bus", "bus", "bus"]


def test_city_slug(spark):
    df = spark.createDataFrame([("München",), ("Frankfurt am Main",), ("Köln",), ("Düsseldorf",)], "n string")
    got = [r[0] for r in df.select(T.city_slug("n")).collect()]
    assert got == ["munchen", "frankfurt-am-main", "koln", "dusseldorf"]


def test_fmt_delay_and_map_class(spark):
    df = spark.createDataFrame([(0.0,), (42.4,), (185.0,), (None,), (301.0,)], "d double")
    got = [tuple(r) for r in df.select(T.fmt_delay("d"), B.map_delay_class("d")).collect()]
    assert got == [("on time", "on-time"), ("42s", "mid"), ("3m 5s", "late"), (None, "on-time"), ("5m 1s", "severe")]


def test_weather_hourly_keeps_latest_condition_even_if_null(spark):  # A7
    w = spark.createDataFrame([("Z22", 1.0, 0.0, 1.0, 50.0, "rain", TS, True),
                               ("Z22", 3.0, 1.0, 3.0, 60.0, None, TS + dt.timedelta(minutes=10), True)],
                              "zone_id string, temperature_c double, precipitation_mm double, wind_speed_kmh double, "
                              "humidity_pct double, condition string, event_ts timestamp, dqr_valid boolean")
    r = staging.weather_hourly(w).first()
    assert r["condition"] is None and r["temperature_c"] == 2.0 and r["obs_count"] == 2


def test_final_ended_record_reusing_event_ts(spark):  # T6
    t1, t2 = TS, TS + dt.timedelta(minutes=5)
    later = t2 + dt.timedelta(seconds=1)
    ev = spark.createDataFrame([
        ("EV1", 52.5, 13.4, "ACTIVE", t1, t1), ("EV1", 52.5, 13.4, "ACTIVE", t2, t2),
        ("EV1", 52.5, 13.4, "ENDED", t2, later),   # final record, same event_ts as the previous one
        ("EV2", 52.6, 13.5, "ACTIVE", t1, t1)],
        "event_id string, lat double, lon double, status string, event_ts timestamp, ingested_ts timestamp")
    silver = dedup.dedup_latest(ev, ["event_id", "event_ts"])
    assert {(r["event_id"], r["event_ts"], r["status"]) for r in silver.collect()} == {
        ("EV1", t1, "ACTIVE"), ("EV1", t2, "ENDED"), ("EV2", t1, "ACTIVE")}
    assert [r["event_id"] for r in staging.active_events(silver).collect()] == ["EV2"]


def test_live_weather_prefers_own_condition_then_own_coordinates(spark):  # A18, J11
    from tramline.plans import live
    tu = spark.createDataFrame([
        ("T1", "S1", "V1", TS, 10.0, "snow", None, None),       # own condition wins
        ("T2", "S1", "V2", TS, 20.0, None, 52.50, 13.40),       # own coordinates -> zone A
        ("T3", "S1", "V1", TS, 30.0, None, None, None),         # vehicle's latest position -> zone B
        ("T4", "S1", "V9", TS, 40.0, None, None, None)],        # nothing known
        "trip_id string, stop_id string, vehicle_id string, event_ts timestamp, delay_seconds double, "
        "condition string, lat double, lon double")
    pos = spark.createDataFrame([("V1", 52.60, 13.60, TS)], "vehicle_id string, lat double, lon double, event_ts timestamp")
    wx = spark.createDataFrame([("ZA", 52.50, 13.40, "rain", TS), ("ZB", 52.60, 13.60, "fog", TS)],
                               "zone_id string, lat double, lon double, condition string, event_ts timestamp")
    got = {r["condition"]: r["observations"] for r in live.weather_impact(tu, pos, wx).collect()}
    assert got == {"snow": 1, "rain": 1, "fog": 1, "unknown": 1}


def test_quality_overall_flag(spark):
    from tramline.operators import quality as Q
    res = Q.validate(spark.createDataFrame([("a",)], "trip_id string"), "t", [Q.rule(Q.NOT_NULL, "trip_id")])
    assert Q.overall(Q.summarize(res)).first()["all_passed"] is True


def test_live_since_bound_prunes_history(spark):
    from tramline.plans import live
    pos = spark.createDataFrame([("V1", TS - dt.timedelta(days=2), 1.0), ("V1", TS, 2.0), ("V2", TS - dt.timedelta(days=3), 5.0)],
                                "vehicle_id string, event_ts timestamp, delay_seconds double")
    assert {r["vehicle_id"] for r in live.latest_positions(pos, since=TS - dt.timedelta(days=1)).collect()} == {"V1"}
    assert live.latest_positions(pos).count() == 2


def test_window_positions_equal_full_latest_for_window_vehicles(spark):  # J11
    from tramline.plans import live
    from tramline.sources.fixtures import Fixture
    from .conftest import SF_SMALL
    fx = Fixture(spark, SF_SMALL)
    pos = fx.positions()
    window = live.live_window(fx.trip_updates(), n=100)
    assert window.count() == 100
    got = live.window_positions(window, pos)
    full = live.latest_positions(pos).join(window.select("vehicle_id").distinct(), "vehicle_id") \
        .select("vehicle_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    key = lambda r: (r["vehicle_id"], str(r["p_lat"]), str(r["p_lon"]))
    assert sorted(rows(got), key=key) == sorted(rows(full), key=key)
    assert got.count() == window.select("vehicle_id").distinct().count()


def test_hotspot_condition_is_latest_in_cell(spark):  # A3, A7 (condition carried as a code)
    later = TS + dt.timedelta(minutes=5)
    fact = spark.createDataFrame(
        [("52.50_13.40", 52.5, 13.4, "V1", 10.0, 0.2, 30.0, "on_time", "rain", TS),
         ("52.50_13.40", 52.5, 13.4, "V2", 20.0, 0.4, 700.0, "severe", "snow", later),
         ("52.51_13.40", 52.51, 13.4, "V1", 10.0, 0.2, 30.0, "on_time", "fog", TS),
         ("52.51_13.40", 52.51, 13.4, "V3", 10.0, 0.2, 30.0, "on_time", None, later)],
        "grid_cell string, cell_lat double, cell_lon double, vehicle_id string, speed_kmh double, "
        "congestion_level double, delay_seconds double, delay_bucket string, condition string, event_ts timestamp")
    got = {r["grid_cell"]: r for r in rows(marts.congestion_hotspots(fact, as_of=later))}
    assert got["52.50_13.40"]["condition"] == "snow" and got["52.50_13.40"]["vehicles"] == 2
    assert got["52.51_13.40"]["condition"] == "unknown"
    assert got["52.50_13.40"]["congestion_rank"] == 1


def test_nearest_event_equals_brute_force(spark):  # J6
    import random
    rng = random.Random(3)
    at = lambda m: TS + dt.timedelta(minutes=m)
    evs = []
    for k in range(120):
        start = rng.randrange(-300, 300)
        far = 1.5 if k % 10 == 0 else 0.05
        evs.append((f"E{k}", 52.5 + rng.uniform(-far, far), 13.4 + rng.uniform(-far, far), at(start),
                    at(start + rng.choice([5, 30, 90, 400])), k / 100, "ACTIVE" if k % 7 else "ENDED"))
    pts = [(k, rng.choice([52.5, 52.52, 52.9]), rng.choice([13.4, 13.45]), at(rng.randrange(-400, 400))) for k in range(300)]
    points = spark.createDataFrame(pts + [(999, None, 13.4, TS)], "k int, stop_lat double, stop_lon double, event_ts timestamp")
    got = {r["k"]: (r["nearest_event_id"], round(r["event_proximity_km"], 6))
           for r in nearest_active_event(points, _events(spark, evs), ["k"]).collect()}
    import math

    def km(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * \
            math.sin(math.radians(d - b) / 2) ** 2
        return math.asin(math.sqrt(h)) * 2 * 6371.0

    want = {}
    for k, lat, lon, ts in pts:
        near = min(((km(lat, lon, e[1], e[2]), e[0]) for e in evs if e[6] == "ACTIVE" and e[3] <= ts <= e[4]), default=None)
        if near:
            want[k] = (near[1], round(near[0], 6))
    assert got == want


def test_dimension_rows_that_repeat_fan_out(spark):  # J2
    from tramline.plans import facts
    from tramline.plans.warehouse import Warehouse
    from .conftest import SF_SMALL
    w = Warehouse.from_fixture(spark, SF_SMALL)
    twice = w.dim_routes.unionByName(w.dim_routes.withColumn("route_mode", F.lit("ferry")))
    fact = facts.fct_trip_delays(w.stg_trip_updates, w.stg_events, w.weather_hourly, w.dim_stops, w.dim_trips, twice,
                                 w.dim_stop_times)
    assert fact.count() == 2 * w.fct_trip_delays.count()
    assert fact.where("route_mode = 'ferry'").count() == w.fct_trip_delays.count()


def test_repeated_update_counts_twice_in_live_impact(spark):  # A20
    from tramline.plans import live
    start, end = TS - dt.timedelta(hours=1), TS + dt.timedelta(hours=1)
    tu = spark.createDataFrame([("T1", "S1", "V1", TS, 10.0)] * 2,
                               "trip_id string, stop_id string, vehicle_id string, event_ts timestamp, delay_seconds double")
    pos = spark.createDataFrame([("V1", 52.5, 13.4, TS)], "vehicle_id string, lat double, lon double, event_ts timestamp")
    ev = spark.createDataFrame([("E1", 52.5, 13.4, "ACTIVE", start, end, TS), ("E2", 53.5, 13.4, "ACTIVE", start, end, TS)],
                               "event_id string, lat double, lon double, status string, start_time_utc timestamp, "
                               "end_time_utc timestamp, event_ts timestamp")
    got = {r["proximity_bucket"]: r["observations"] for r in live.events_impact(tu, pos, ev).collect()}
    assert got == {"within_2km": 2, "far": 2}


def test_slices_cover_an_interval_once(spark):  # J5
    """Every moment meets an interval that holds it once: in one covered slice, or at the slices of its ends."""
    import random
    from tramline.operators import slices as S
    rng = random.Random(1)
    us = lambda t: dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t)
    spans = [(a, a + d) for d in (0, 1, 1 << 23, (1 << 23) * 3 + 5, 10_800_000_000, 40 * 86_400_000_000)
             for a in (rng.randrange(1 << 50), (rng.randrange(1 << 20) << 23))]
    ev = spark.createDataFrame([(k, us(a), us(b), a, b) for k, (a, b) in enumerate(spans)],
                               "k int, s timestamp, e timestamp, a long, b long")
    got = {r.k: r for r in ev.select("k", "a", "b", S.covered_slices("s", "e").alias("c"), S.edge_slices("s", "e").alias("x")).collect()}
    for k, (a, b) in enumerate(spans):
        width = lambda c: 1 << (S.SLICE_BITS + S.RADIX_BITS * c.level)
        covered = sorted((c.slice * width(c), (c.slice + 1) * width(c)) for c in got[k].c)
        assert len(covered) <= 14 * S.TOP + 3
        edges = sorted(got[k].x)
        assert edges == sorted({a >> S.SLICE_BITS, b >> S.SLICE_BITS})
        if covered:
            assert covered[0][0] == (edges[0] + 1) << S.SLICE_BITS and covered[-1][1] == edges[-1] << S.SLICE_BITS
            assert all(x[1] == y[0] for x, y in zip(covered, covered[1:]))
        else:
            assert edges[-1] - edges[0] <= 1


def test_many_short_events_far_away(spark):  # J5, J6
    """A thousand events of minutes in one hour, 90 km from every stop: found by slices and cells, no list of them."""
    start = TS.replace(minute=0)
    evs = [(f"E{k:04}", 53.3 + k * 1e-4, 13.4, start + dt.timedelta(seconds=3 * k), start + dt.timedelta(seconds=3 * k + 240),
            k / 1000, "ACTIVE") for k in range(1000)]
    pts = [(k, 52.5 + 0.01 * (k % 5), 13.4, start + dt.timedelta(seconds=12 * k)) for k in range(300)]
    points = spark.createDataFrame(pts, "k int, stop_lat double, stop_lon double, event_ts timestamp")
    near = nearest_active_event(points, _events(spark, evs), ["k"])
    assert {r.k: r.nearest_event_id for r in near.collect()} == {
        k: min(e[0] for e in evs if e[3] <= ts <= e[4]) for k, _, _, ts in pts if any(e[3] <= ts <= e[4] for e in evs)}
    import inspect
    from tramline.operators import aggregates, nearest
    assert "collect_list" not in inspect.getsource(nearest)
    assert "Window" not in inspect.getsource(aggregates.exact_percentiles) + inspect.getsource(aggregates._narrowed)


def test_percentiles_of_a_group_with_many_values(spark):  # A10
    """Values over many orders of magnitude, ties, a hot group; null and non-finite values take no part."""
    import numpy as np
    from tramline.operators.aggregates import exact_percentiles
    rng = np.random.default_rng(5)
    values = {"hot": np.concatenate([rng.normal(0, 1e4, 20_000), np.full(500, 3.25), [1e300, -1e300, 1e-300, 0.0]]),
              "one": np.array([7.5]), "two": np.array([-1.0, 2.0]), None: rng.integers(0, 5, 200).astype(float)}
    rows_ = [(g, float(v)) for g, vs in values.items() for v in vs] + [("two", None), ("two", float("nan")), ("two", float("inf")), ("gone", None)]
    df = spark.createDataFrame(rows_, "g string, v double")
    qs = {"p0": 0.0, "p5": 0.05, "median": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["g"]: r for r in rows(exact_percentiles(df, ["g"], "v", qs))}
    assert set(got) == set(values)
    for g, vs in values.items():
        assert [got[g][n] for n in qs] == pytest.approx([float(np.quantile(vs, q)) for q in qs.values()], rel=1e-12)


def test_event_search_neither_broadcasts_nor_sorts_events(spark):  # J5, J6
    """Files of events are small beside their rows in memory: no side of the search may be broadcast by file size, and
    the joined pairs are combined by hash."""
    from tramline.operators import nearest as N
    start = TS.replace(minute=0)
    evs = [(f"E{k:03}", 52.5 + 0.001 * (k % 4), 13.4, start + dt.timedelta(minutes=k), start + dt.timedelta(minutes=k + 180), 0.5, "ACTIVE")
           for k in range(100)]
    points = spark.createDataFrame([(k, 52.5, 13.4, start + dt.timedelta(minutes=3 * k)) for k in range(100)],
                                   "k int, stop_lat double, stop_lon double, event_ts timestamp")
    near = N.nearest_active_event(points, _events(spark, evs), ["k"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
    covered, edges = N.sliced(N.numbered(N.active_intervals(_events(spark, evs))), F.col("_n"), F.min)
    assert covered.count() == covered.select("level", "slice", "_ev_lat", "_ev_lon").distinct().count()
    asks = N.asks_of(points, "stop_lat", "stop_lon", "event_ts")
    plan = N.around(asks, covered, edges, 1.0, N._farness(), F.min)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortAggregate" not in plan and "HashAggregate" in plan
    want = {}
    for k in range(100):
        t = start + dt.timedelta(minutes=3 * k)
        at = [(abs(e[1] - 52.5), e[0]) for e in evs if e[3] <= t <= e[4]]
        if at:
            want[k] = min(at)[1]
    assert {r.k: r.nearest_event_id for r in near.collect()} == want


def test_event_search_shuffles_slice_and_cell_as_one_number_each(spark):  # J5, J6
    """Cells on both sides of zero and times before 1970 are told apart."""
    from tramline.operators import nearest as N
    start = dt.datetime(1969, 12, 31, 22, 0)
    evs = [(f"E{k:03}", -0.05 + 0.013 * (k % 9), -0.06 + 0.017 * (k % 7), start + dt.timedelta(minutes=2 * k),
            start + dt.timedelta(minutes=2 * k + 40), 0.5, "ACTIVE") for k in range(90)]
    asked = [(k, -0.07 + 0.011 * (k % 13), -0.08 + 0.019 * (k % 8), start + dt.timedelta(minutes=3 * k, seconds=k)) for k in range(60)]
    points = spark.createDataFrame(asked, "k int, stop_lat double, stop_lon double, event_ts timestamp")
    covered, edges = N.sliced(N.numbered(N.active_intervals(_events(spark, evs))), F.col("_n"), F.min)
    asks = N.asks_of(points, "stop_lat", "stop_lon", "event_ts")
    plan = N.around(asks, covered, edges, 1.0, N._farness(), F.min)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_at#" in plan and "hashpartitioning(level#" not in plan
    import math

    def km(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * \
            math.sin(math.radians(d - b) / 2) ** 2
        return math.asin(math.sqrt(h)) * 2 * 6371.0

    want = {}
    for k, lat, lon, t in asked:
        near = [(km(lat, lon, e[1], e[2]), e[0]) for e in evs if e[3] <= t <= e[4]]
        if near:
            want[k] = min(near)[1]
    got = N.nearest_active_event(points, _events(spark, evs), ["k"]).collect()
    assert len(want) > 40 and {r.k: r.nearest_event_id for r in got} == want


def test_position_functions_show_all_formulas(spark):
    from tramline.functions import geo as G, timefn as T
    df = spark.createDataFrame([(52.52, 13.405, 52.53, 13.405, 180.0, dt.datetime(2024, 1, 1, 7, 30)),
                                (52.52, 13.405, 52.52, 13.395, -5.0, dt.datetime(2024, 1, 1, 17, 0))],
                               "a double, b double, c double, d double, delay double, ts timestamp")
    got = df.select(G.heading_deg("a", "b", "c", "d"), G.congestion_level("delay"), T.rush_hour_factor("ts")).collect()
    import math
    rush = 1 + 0.35 * (1 + math.exp(-25))
    assert [tuple(r) for r in got] == [pytest.approx((0.0, 0.5, rush)), pytest.approx((270.0, 1.0, rush))]


def test_position_functions_columns(spark):
    from tramline import registry
    from .conftest import SF_SMALL
    names = {"congestion_from_delay", "heading_from_centre", "rush_factor"}
    fn, sql = registry.QUERIES["position_functions"]
    assert names <= set(fn(spark, SF_SMALL).columns) and all(f" AS {n}," in sql for n in names)
