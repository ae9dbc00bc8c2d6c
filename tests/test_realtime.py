"""GTFS-RT reduction edge cases (hand-made nested entities)."""
import datetime as dt

from tramline.plans.realtime import cap_per_poll, reduce_trip_updates

FEED_T = "entity_id string, feed_ts timestamp, trip_update struct<trip:struct<trip_id:string,route_id:string>," \
         "vehicle:struct<id:string>,delay:double,stop_time_update:array<struct<stop_id:string,stop_sequence:int," \
         "arrival:struct<delay:double,time:bigint>,departure:struct<delay:double,time:bigint>>>>"
NOW = dt.datetime(2024, 1, 1, 12, 0, 0)
T0 = 1704110400  # 2024-01-01T12:00:00Z


def _su(stop, seq, arr=None, dep=None):
    return (stop, seq, arr, dep)


def test_reduction_rules(spark):
    feed = spark.createDataFrame([
        # largest |delay| among city stops; departure used when arrival has no delay; tie keeps the first
        ("e1", NOW, (("T1", "F1"), ("V1",), None, [_su("A", 1, (30.0, T0), None), _su("X", 2, (900.0, T0), None),
                                                   _su("B", 3, (None, T0), (-200.0, T0 + 60)),
                                                   _su("A", 4, (200.0, T0), None)])),
        # departure only, no vehicle
        ("e2", NOW, (("T2", None), None, None, [_su("B", 1, None, (45.0, T0 + 10))])),
        # trip-level delay only: first city stop, timestamps from 'now'
        ("e3", NOW, (("TX", "F9"), ("",), 90.0, [_su("X", 1), _su("A", 2), _su("B", 3)])),
        # no city stop at all: dropped
        ("e4", NOW, (("T4", "F4"), ("V4",), 50.0, [_su("X", 1, (10.0, T0), None)])),
        # nothing usable and no trip delay: dropped
        ("e5", NOW, (("T5", "F5"), ("V5",), None, [_su("A", 1)])),
    ], FEED_T)
    stops = spark.createDataFrame([("A",), ("B",)], "stop_id string")
    trips = spark.createDataFrame([("T1", "R1"), ("T2", "R2")], "trip_id string, route_id string")
    got = {r["entity_id"]: r for r in reduce_trip_updates(feed, stops, trips).collect()}
    assert set(got) == {"e1", "e2", "e3"}
    e1 = got["e1"]
    assert (e1["stop_id"], e1["stop_sequence"], e1["delay_seconds"], e1["status"]) == ("B", 3, -200.0, "EARLY")
    assert e1["route_id"] == "R1" and e1["vehicle_id"] == "V1"
    # the delay comes from the departure, the time from the arrival (it has one)
    assert e1["actual_arrival_utc"] == NOW and e1["scheduled_arrival_utc"] == NOW + dt.timedelta(seconds=200)
    e2 = got["e2"]
    assert (e2["stop_id"], e2["delay_seconds"], e2["vehicle_id"], e2["route_id"]) == ("B", 45.0, "rt-e2", "R2")
    assert e2["scheduled_arrival_utc"] == NOW + dt.timedelta(seconds=10 - 45)
    e3 = got["e3"]
    assert (e3["stop_id"], e3["delay_seconds"], e3["vehicle_id"], e3["route_id"]) == ("A", 90.0, "rt-e3", "F9")
    assert e3["scheduled_arrival_utc"] == NOW and e3["actual_arrival_utc"] == NOW + dt.timedelta(seconds=90)


def test_cap_per_poll_keeps_largest_abs_delay(spark):
    rows = [("p1", f"e{i}", float(d)) for i, d in enumerate([5, -300, 40, 200, -7])] + [("p2", "z", 1.0)]
    df = spark.createDataFrame(rows, "poll_id string, entity_id string, delay_seconds double")
    got = sorted((r["poll_id"], r["delay_seconds"]) for r in cap_per_poll(df, cap=2).collect())
    assert got == [("p1", -300.0), ("p1", 200.0), ("p2", 1.0)]


def test_entities_of_two_polls_stay_apart(spark):  # C5
    later = NOW + dt.timedelta(seconds=20)
    feed = spark.createDataFrame([
        ("e1", NOW, (("T1", "F1"), ("V1",), None, [_su("A", 1, (30.0, T0), None)])),
        ("e1", later, (("T2", "F2"), ("V2",), None, [_su("A", 1, (90.0, T0), None)]))], FEED_T)
    stops = spark.createDataFrame([("A",)], "stop_id string")
    trips = spark.createDataFrame([], "trip_id string, route_id string")
    got = sorted((r["event_ts"], r["trip_id"], r["delay_seconds"]) for r in reduce_trip_updates(feed, stops, trips).collect())
    assert got == [(NOW, "T1", 30.0), (later, "T2", 90.0)]
