"""Structured Streaming: quarantine of malformed messages, watermark drops
late rows, idempotent foreachBatch sinks."""
import datetime as dt
import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from tramline.streaming import bronze as B, continuous as C, state as S


def _write(path, name, lines, mtime):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(p, (mtime, mtime))


def _tu(trip, ts, delay):
    return json.dumps({"trip_id": trip, "route_id": "R1", "vehicle_id": "V1", "stop_id": "S1", "stop_sequence": 1,
                       "delay_seconds": delay, "status": "ON_TIME", "event_ts": ts})


def test_bronze_quarantine(spark):
    root = tempfile.mkdtemp(prefix="tramline-test-")
    _write(f"{root}/feed/trip_updates", "a.json",
           [_tu("T1", "2024-01-01T10:05:00+00:00", 30.0), "{broken", _tu("T2", "2024-01-01T10:06+00:00", 60.0)],
           time.time() - 10)
    src = B.Source(kind="files", path=f"{root}/feed")
    q = B.start_bronze(spark, "trip_updates", src, f"{root}/out", f"{root}/ckpt", trigger={"availableNow": True})
    B.await_all(spark, [q])
    good = B.read_bronze(spark, f"{root}/out", "trip_updates")
    bad = B.read_quarantine(spark, f"{root}/out", "trip_updates")
    assert sorted(r["trip_id"] for r in good.collect()) == ["T1", "T2"]
    assert [r["_corrupt_record"] for r in bad.collect()] == ["{broken"]
    assert good.where(F.col("ingested_ts").isNull()).count() == 0


def test_unknown_fields_are_kept(spark):
    from tramline.sources.streams import extra_field
    root = tempfile.mkdtemp(prefix="tramline-test-")
    more = json.loads(_tu("T1", "2024-01-01T10:05:00+00:00", 30.0)) | {"agency": {"id": 7, "tags": ["x", "y"]}, "delay": "soon"}
    _write(f"{root}/feed/trip_updates", "a.json", [json.dumps(more), _tu("T2", "2024-01-01T10:06:00+00:00", 1.0), "{broken"], time.time() - 10)
    src = B.Source(kind="files", path=f"{root}/feed")
    B.await_all(spark, [B.start_bronze(spark, "trip_updates", src, f"{root}/out", f"{root}/ckpt", trigger={"availableNow": True})])
    rows = B.read_extra(spark, f"{root}/out", "trip_updates").select(
        "trip_id", extra_field("$.agency.id", "bigint"), extra_field("$.agency.tags[1]", "string"), extra_field("$.delay", "double"),
        F.col("extra").isNull()).collect()
    assert sorted(map(tuple, rows)) == [("T1", 7, "y", None, False), ("T2", None, None, None, True)]
    assert "extra" not in B.read_bronze(spark, f"{root}/out", "trip_updates").columns


def test_late_rows_are_dropped_by_the_watermark(spark):
    root = tempfile.mkdtemp(prefix="tramline-test-")
    now = time.time()
    _write(f"{root}/feed/trip_updates", "1.json",
           [_tu("T1", "2024-01-01T10:05:00+00:00", 10.0), _tu("T2", "2024-01-01T10:20:00+00:00", 20.0),
            _tu("T3", "2024-01-01T11:30:00+00:00", 30.0)], now - 100)
    _write(f"{root}/feed/trip_updates", "2.json", [_tu("T5", "2024-01-01T12:30:00+00:00", 50.0)], now - 50)
    # Spark filters late rows against the previous batch's watermark (11:20 here,
    # and the 10:00 window was already emitted): the 10:40 row is dropped
    _write(f"{root}/feed/trip_updates", "3.json", [_tu("T4", "2024-01-01T10:40:00+00:00", 1000.0)], now - 20)
    src = B.Source(kind="files", path=f"{root}/feed", max_files_per_trigger=1)
    typed = B.bronze_stream(B.raw_messages(spark, "trip_updates", src), "trip_updates").drop("_corrupt_record", "extra")
    silver = C.silver_flags(C.dedup_stream(typed, "trip_updates"), "trip_updates")
    q = (C.hourly_delay_trend(silver, watermark=None).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start(f"{root}/out"))
    q.awaitTermination()
    out = {r["window_start"].hour: (r["observations"], r["avg_delay_seconds"])
           for r in spark.read.parquet(f"{root}/out").collect()}
    assert out[10] == (2, 15.0)        # the late 10:40 row is not counted
    assert out.get(11) == (1, 30.0)    # closed once the watermark passed 12:00
    assert 12 not in out               # still open at the end


def _state(spark, root):
    df = spark.createDataFrame([], "vehicle_id string, v double, event_ts timestamp")
    return {r["vehicle_id"]: r["v"] for r in S.read_state(spark, f"{root}/log", "vehicle_id", df.schema).collect()}


def test_changelog_is_idempotent_and_folded(spark):
    from tramline.sources import folders
    root = tempfile.mkdtemp(prefix="tramline-test-")
    write = S.compacting_writer(f"{root}/log", "vehicle_id", every=2)
    at = lambda *rows: spark.createDataFrame(
        [(v, x, dt.datetime(2024, 1, 1, h)) for v, x, h in rows], "vehicle_id string, v double, event_ts timestamp")
    write(at(("V1", 1.0, 1)), 0)
    write(at(("V1", 1.0, 1)), 0)  # replay of the same batch
    write(at(("V1", 2.0, 2), ("V2", 5.0, 2)), 1)
    assert _state(spark, root) == {"V1": 2.0, "V2": 5.0}
    write(at(("V3", 7.0, 3)), 2)
    assert [n for n in folders.names(spark, f"{root}/log/changes") if n != "_SUCCESS"] == ["batch_id=2"]
    assert folders.names(spark, f"{root}/log/snapshots") == ["upto=2"]
    write(at(("V3", 7.0, 3)), 2)  # replay of the batch that folded
    write(at(("V1", 1.5, 1), ("V2", 6.0, 4)), 3)  # an older row of V1 does not win
    assert _state(spark, root) == {"V1": 2.0, "V2": 6.0, "V3": 7.0}
    folders.delete(spark, f"{root}/log/snapshots/upto=2/_SUCCESS")  # a snapshot that was cut short is no snapshot
    assert _state(spark, root) == {"V1": 1.5, "V2": 6.0, "V3": 7.0}


def test_idle_keys_leave_the_state(spark):
    """Two vehicles go silent: their state is dropped after an hour of event time; the active one and a returning one
    are held; rows of a key in one batch and ties go as in batch."""
    root = tempfile.mkdtemp(prefix="tramline-test-")
    now = time.time()
    pos = lambda v, t, s: json.dumps({"vehicle_id": v, "event_ts": f"2024-01-01T{t}:00+00:00", "speed_kmh": s})
    feeds = [[pos("V1", "10:00", 1.0), pos("V1", "10:05", 2.0), pos("V1", "10:05", 1.5), pos("V2", "10:00", 3.0), pos("V3", "10:00", 4.0)],
             [pos("V3", "12:00", 5.0), pos(None, "12:00", 5.0)], [pos("V3", "12:30", 6.0)],
             [pos("V1", "13:00", 7.0), pos("V3", "12:50", 8.0)], [pos("V3", "13:30", 9.0)]]
    for k, lines in enumerate(feeds):
        _write(f"{root}/feed/transport_positions", f"{k}.json", lines, now - 100 + k)
    src = B.Source(kind="files", path=f"{root}/feed", max_files_per_trigger=1)
    typed = B.bronze_stream(B.raw_messages(spark, "transport_positions", src), "transport_positions").drop("_corrupt_record", "extra")
    changes = S.latest_with_ttl(typed, "vehicle_id", ttl_seconds=3600)
    q = (changes.writeStream.outputMode("update").option("checkpointLocation", f"{root}/ckpt")
         .foreachBatch(S.compacting_writer(f"{root}/log", "vehicle_id", every=100)).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    log = spark.read.parquet(f"{root}/log/changes").select("vehicle_id", "speed_kmh", "expired").collect()
    assert sorted((r.vehicle_id, r.speed_kmh) for r in log if r.expired) == [("V1", 2.0), ("V2", 3.0)]
    assert sorted((r.vehicle_id, r.speed_kmh) for r in log if not r.expired) == [
        ("V1", 2.0), ("V1", 7.0), ("V2", 3.0), ("V3", 4.0), ("V3", 5.0), ("V3", 6.0), ("V3", 8.0), ("V3", 9.0)]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert held[-1] < max(held)


def test_upserts_keep_the_latest_and_touch_only_their_dates(spark):
    from tramline.sources import folders
    root = tempfile.mkdtemp(prefix="tramline-test-")
    write = S.upsert_writer(f"{root}/t", ["k", "event_ts"])
    at = lambda day, m: dt.datetime(2024, 1, day, 10, m)
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, event_ts timestamp, v double, ingested_ts timestamp")
    read = lambda: sorted((r.k, r.v) for r in spark.read.parquet(f"{root}/t").collect())
    write(frame(("a", at(1, 0), 1.0, at(1, 1)), ("b", at(2, 0), 2.0, at(2, 1)), ("n", None, 9.0, at(1, 1))), 0)
    untouched = os.listdir(f"{root}/t/service_date=2024-01-02")
    write(frame(("a", at(1, 0), 1.5, at(1, 9)), ("c", at(1, 0), 3.0, at(1, 9)), ("n", None, 8.0, at(1, 0))), 1)
    write(frame(("a", at(1, 0), 0.5, at(1, 5))), 2)  # an older correction comes last
    assert read() == [("a", 1.5), ("b", 2.0), ("c", 3.0), ("n", 9.0)]
    assert os.listdir(f"{root}/t/service_date=2024-01-02") == untouched
    # a loss after the merge was written aside, with the table's dates half gone: the replay completes it
    spark.createDataFrame([("a", at(1, 0), 4.0, at(1, 30), at(1, 0).date())],
                          "k string, event_ts timestamp, v double, ingested_ts timestamp, service_date date") \
        .write.parquet(f"{root}/t_merges/batch_id=3")
    folders.delete(spark, f"{root}/t/service_date=2024-01-01")
    write(frame(("zzz", at(1, 0), 0.0, at(1, 0))), 3)
    assert ("a", 4.0) in read() and ("b", 2.0) in read() and folders.names(spark, f"{root}/t_merges") == []


def test_counters_outlast_a_hundred_batches(spark):
    root = tempfile.mkdtemp(prefix="tramline-test-")
    now = time.time()
    for k in range(60):
        _write(f"{root}/feed/trip_updates", f"{k:03}.json", ["x"] * (k + 1), now - 1000 + k)

    def run():
        ledger = S.ProgressLedger(spark, f"{root}/ckpt/counters")
        spark.streams.addListener(ledger)
        raw = B.raw_messages(spark, "trip_updates", B.Source(kind="files", path=f"{root}/feed", max_files_per_trigger=1))
        q = (raw.writeStream.foreachBatch(lambda b, i: b.write.format("noop").mode("append").save())
             .option("checkpointLocation", f"{root}/ckpt/q").trigger(availableNow=True).start())
        q.awaitTermination()
        totals = ledger.settled(q)
        spark.streams.removeListener(ledger)
        return totals

    assert run()["rows"] == 60 * 61 // 2
    for k in range(60, 110):
        _write(f"{root}/feed/trip_updates", f"{k:03}.json", ["x"] * (k + 1), now - 800 + k)
    totals = run()  # another start over the same checkpoint goes on counting
    assert totals["rows"] == 110 * 111 // 2 and totals["batches"] == 110


def test_raw_record_and_topic_encoding(spark):
    from tramline.sources.streams import to_raw_records, to_topic_messages
    df = spark.createDataFrame([("V1", 52.5)], "vehicle_id string, lat double") \
        .withColumn("event_ts", F.to_timestamp(F.lit("2024-01-01 10:00:00")))
    raw = to_raw_records(df).first()
    assert json.loads(raw["record"])["vehicle_id"] == "V1" and raw["ingested_ts"] is not None
    assert json.loads(to_topic_messages(df).first()["value"])["lat"] == 52.5


def test_all_streams_supervised_with_progress_counters(spark):
    root = tempfile.mkdtemp(prefix="tramline-test-")
    from tramline.schemas import STREAMS
    for s in STREAMS:
        _write(f"{root}/feed/{s}", "a.json", ['{"event_ts": "2024-01-01T10:00:00+00:00"}', "garbage"], time.time() - 5)
    src = B.Source(kind="files", path=f"{root}/feed")
    qs = B.start_all(spark, src, f"{root}/out", f"{root}/ckpt", trigger={"availableNow": True})
    assert len(qs) == 4
    B.await_all(spark, qs)
    assert all(not q.isActive for q in qs)
    for s in STREAMS:
        assert B.read_bronze(spark, f"{root}/out", s).count() == 1
        assert B.read_quarantine(spark, f"{root}/out", s).count() == 1


def test_failing_stream_stops_its_siblings(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="tramline-test-")
    _write(f"{root}/feed/trip_updates", "a.json", [_tu("T1", "2024-01-01T10:05:00+00:00", 30.0)], time.time() - 10)
    src = B.Source(kind="files", path=f"{root}/feed")
    raw = B.raw_messages(spark, "trip_updates", src)

    def fails(batch, batch_id):
        raise ValueError("sink is gone")

    sibling = raw.writeStream.foreachBatch(lambda b, i: None).option("checkpointLocation", f"{root}/c1") \
        .trigger(processingTime="1 second").start()
    broken = raw.writeStream.foreachBatch(fails).option("checkpointLocation", f"{root}/c2").start()
    with pytest.raises(RuntimeError, match="sink is gone"):
        B.await_all(spark, [sibling, broken])
    assert not sibling.isActive


def test_registered_streams_run_in_several_batches(spark):
    from tramline.sources.fixtures import Fixture
    from tramline.streaming.runner import BATCHES, StreamRun
    from .conftest import SF_SMALL
    run = StreamRun(spark, {"trip_updates": Fixture(spark, SF_SMALL).trip_updates()})
    out = run.run_append(run.silver("trip_updates"), "silver")
    assert run.batches == BATCHES and out.count() == 1000
