"""Deterministic adapters: transit-shaped Bronze and GTFS tables derived from
the driver's parquet tables (events, supplier, nation).

Every adapter is a plain DataFrame transformation of the given tables, so its
size grows with them. The same rules exist as SQL in ``tramline.oracle`` for
the DuckDB cross-check.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.buckets import trip_status
from ..params import CITY_LAT, CITY_LON, ROUTE_TYPE_BY_MODE, AGENCY_ID

# Fixed values of the adapter rules (FIXTURES.md section 3).
MODES = ["rail", "tram", "bus"]                       # by key % 3
CONDITION_BY_EVENT_TYPE = {"click": "rain", "error": "clear", "purchase": "storm",
                           "signup": "hail", "view": "clouds"}
CATEGORY_BY_EVENT_TYPE = {"click": "concert", "error": "sports", "purchase": "fair",
                          "signup": "demonstration", "view": "festival"}
N_STOPS = 40
N_ROUTES = 25


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(prefix: str, c) -> F.Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _mode(k) -> F.Column:
    return F.when(k % 3 == 0, F.lit(MODES[0])).when(k % 3 == 1, F.lit(MODES[1])).otherwise(F.lit(MODES[2]))


def _lookup(col, mapping: dict) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def _delay(ev) -> F.Column:
    return F.when(ev.event_id % 50 == 0, F.lit(None).cast("double")).otherwise(ev.value * 8.0 - 100.0)


def stops(supplier: DataFrame) -> DataFrame:
    k = F.col("k")
    return (supplier.groupBy((F.col("s_suppkey") % N_STOPS).alias("k"))
            .agg(F.min("s_name").alias("stop_name"))
            .select(_s("S", k).alias("stop_id"), "stop_name",
                    (F.lit(52.442) + (k % 17).cast("double") * F.lit(0.01)).alias("stop_lat"),
                    (F.lit(13.302) + (k % 23).cast("double") * F.lit(0.01)).alias("stop_lon"),
                    F.when(k % 10 == 0, F.lit("")).otherwise(_s("Z", F.lit(1) + k % 5)).alias("stop_zone")))


def routes(nation: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    mode = _mode(k)
    return nation.select(
        _s("R", k).alias("route_id"), F.lit(AGENCY_ID).alias("agency_id"),
        _s("L", k).alias("route_short_name"), F.col("n_name").alias("route_long_name"),
        _lookup(mode, ROUTE_TYPE_BY_MODE).cast("int").alias("route_type"),
        mode.alias("route_mode"))


def trips(events: DataFrame) -> DataFrame:
    u = F.col("user_id")
    return events.select(
        _s("T", u).alias("trip_id"), _s("R", u % N_ROUTES).alias("route_id"),
        F.lit("WD").alias("service_id"), (u % 2).cast("int").alias("direction_id"),
        _s("H", u % N_ROUTES).alias("trip_headsign")).distinct()


def _clock(h, m, s: str) -> F.Column:
    return F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.lpad(m.cast("string"), 2, "0"), F.lit(s))


def stop_times(events: DataFrame) -> DataFrame:
    seq = F.col("event_id") % N_STOPS
    return events.select(
        _s("T", F.col("user_id")).alias("trip_id"), _s("S", seq).alias("stop_id"),
        seq.cast("int").alias("stop_sequence"),
        _clock(F.lit(5) + F.floor(seq / 4), (seq % 4) * 15, ":00").alias("arrival_time"),
        _clock(F.lit(5) + F.floor(seq / 4), (seq % 4) * 15, ":30").alias("departure_time")).distinct()


def trip_updates_bronze(events: DataFrame) -> DataFrame:
    ev = events
    ts = ev.ts.cast("timestamp")
    delay = _delay(ev)
    actual = F.timestamp_micros(F.unix_micros(ts) + F.round(delay * 1e6).cast("long"))
    return ev.select(
        _s("T", ev.user_id).alias("trip_id"), _s("R", ev.user_id % N_ROUTES).alias("route_id"),
        _s("V", ev.user_id).alias("vehicle_id"), _s("S", ev.event_id % N_STOPS).alias("stop_id"),
        (ev.event_id % N_STOPS).cast("int").alias("stop_sequence"),
        ts.alias("scheduled_arrival_utc"), actual.alias("actual_arrival_utc"),
        delay.alias("delay_seconds"), trip_status(delay).alias("status"),
        ts.alias("event_ts"), ts.alias("ingested_ts"))


def positions_bronze(events: DataFrame) -> DataFrame:
    ev = events
    ts = ev.ts.cast("timestamp")
    return ev.select(
        _s("V", ev.user_id).alias("vehicle_id"), _s("R", ev.user_id % N_ROUTES).alias("route_id"),
        _mode(ev.user_id % N_ROUTES).alias("route_mode"), _s("T", ev.user_id).alias("trip_id"),
        (ev.user_id % 2).cast("int").alias("direction_id"),
        _s("S", ev.event_id % N_STOPS).alias("stop_id"),
        _s("S", (ev.event_id + 1) % N_STOPS).alias("next_stop_id"),
        (F.lit(52.332) + (ev.event_id % 37).cast("double") * F.lit(0.01)).alias("lat"),
        F.when(ev.event_id % 101 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(13.102) + (ev.event_id % 61).cast("double") * F.lit(0.01)).alias("lon"),
        (ev.value - 20.0).alias("speed_kmh"),
        ((ev.event_id * 37) % 360).cast("double").alias("heading_deg"),
        _delay(ev).alias("delay_seconds"),
        ((ev.event_id % 100).cast("double") / 100.0).alias("congestion_level"),
        ts.alias("event_ts"), ts.alias("ingested_ts"))


def weather_bronze(events: DataFrame) -> DataFrame:
    """Some observations come again, corrected by one degree and ingested a second later."""
    first = events.select("*", F.lit(0).alias("again"))
    ev = first.unionByName(events.where(F.col("event_id") % 20 == 3).select("*", F.lit(1).alias("again")))
    ts = ev.ts.cast("timestamp")
    ix = ev.event_id % 5
    iy = F.floor((ev.event_id % 25) / 5)
    return ev.select(
        F.concat(F.lit("Z"), ix.cast("string"), iy.cast("string")).alias("zone_id"),
        (F.lit(CITY_LAT) + (ix - 2).cast("double") * F.lit(0.03)).alias("lat"),
        (F.lit(CITY_LON) + (iy - 2).cast("double") * F.lit(0.03)).alias("lon"),
        (ev.value / 5.0 - 10.0 + ev.again).alias("temperature_c"),
        (ev.value / 5.0 - 12.0).alias("feels_like_c"),
        (ev.value / 7.0 + 20.0).alias("humidity_pct"),
        (ev.value / 4.0).alias("wind_speed_kmh"),
        F.when(ev.event_id % 3 == 0, F.lit(0.0)).otherwise(ev.value / 20.0).alias("precipitation_mm"),
        _lookup(ev.event_type, CONDITION_BY_EVENT_TYPE).alias("condition"),
        F.lit(10.0).alias("visibility_km"),
        ts.alias("event_ts"), (ts + F.make_dt_interval(secs=ev.again)).alias("ingested_ts"))


def city_events_bronze(events: DataFrame) -> DataFrame:
    ev = events
    ts = ev.ts.cast("timestamp")
    return ev.select(
        _s("EV-", ev.event_id).alias("event_id"), _s("Event ", ev.event_id).alias("name"),
        _lookup(ev.event_type, CATEGORY_BY_EVENT_TYPE).alias("category"),
        (F.lit(52.482) + (ev.event_id % 13).cast("double") * F.lit(0.007)).alias("lat"),
        (F.lit(13.352) + (ev.event_id % 11).cast("double") * F.lit(0.011)).alias("lon"),
        ts.alias("start_time_utc"), (ts + F.expr("INTERVAL 3 HOURS")).alias("end_time_utc"),
        F.floor(ev.value * 100.0).cast("long").alias("expected_attendance"),
        ((ev.event_id % 10).cast("double") / 10.0).alias("impact"),
        F.lit(3.0).alias("impact_radius_km"),
        F.when(ev.event_id % 7 == 0, F.lit("ENDED")).otherwise(F.lit("ACTIVE")).alias("status"),
        ts.alias("event_ts"), ts.alias("ingested_ts"))


#: Which rows come again, and how many minutes later than the first time.
CORRECTED_MODULUS, CORRECTED_REST, CORRECTED_MINUTES = 20, 3, 90


def with_corrections(bronze: DataFrame, change: dict) -> DataFrame:
    """A fifth of the rows come again, one to four times, with other values and later arrivals."""
    text = F.unix_micros("event_ts").cast("string")
    h = F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("long") % CORRECTED_MODULUS
    again = bronze.where(h <= CORRECTED_REST).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(4) - h.cast("int"))))
    later = F.col("ingested_ts") + F.make_dt_interval(mins=F.lit(CORRECTED_MINUTES) * F.col("_n"))
    return bronze.unionByName(again.withColumns({c: f(F.col("_n")) for c, f in change.items()} | {"ingested_ts": later}).drop("_n"))


CORRECTIONS = {
    "trip_updates": {"delay_seconds": lambda n: F.col("delay_seconds") + 45.0 * n, "status": lambda n: F.lit("DELAYED")},
    "transport_positions": {"speed_kmh": lambda n: F.col("speed_kmh") + 2.0 * n, "lat": lambda n: F.col("lat") + 0.001 * n},
    "city_events": {"impact": lambda n: F.lit(0.05) * n, "status": lambda n: F.lit("ENDED")},
}


class Fixture:
    """Lazily derived Bronze + GTFS tables for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._events = None

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    def stops(self): return stops(self.table("supplier"))
    def routes(self): return routes(self.table("nation"))
    def trips(self): return trips(self.events)
    def stop_times(self): return stop_times(self.events)
    def trip_updates(self): return trip_updates_bronze(self.events)
    def positions(self): return positions_bronze(self.events)
    def weather(self): return weather_bronze(self.events)
    def city_events(self): return city_events_bronze(self.events)


def gtfs_rt_feed(events: DataFrame) -> DataFrame:
    """Decoded GTFS-RT trip-update entities, one per event, with 0..3 stop time
    updates (some at stops outside the city, some without arrival or
    departure, some without delays or times) and optional trip-level delay.
    A fifth of the entities come again in a poll 20 seconds later."""
    later = events.where(F.col("event_id") % 5 == 0).withColumn("value", F.col("value") + 30.0).withColumn(
        "ts", F.col("ts") + F.expr("INTERVAL 20 SECONDS"))
    e = events.unionByName(later)
    ts = e.ts.cast("timestamp")
    t0 = F.unix_seconds(ts)
    ev_t = "struct<delay:double,time:bigint>"

    def su(j: int):
        k = e.event_id + j
        arrival = F.when(k % 5 == 0, F.lit(None).cast(ev_t)).otherwise(F.struct(
            F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise(e.value * (j + 1) - 150.0).alias("delay"),
            (t0 + 120 * j).alias("time")))
        departure = F.when(k % 4 == 1, F.lit(None).cast(ev_t)).otherwise(F.struct(
            (e.value - 60.0 * j).alias("delay"),
            F.when(k % 6 == 0, F.lit(None).cast("bigint")).otherwise(t0 + 120 * j + 30).alias("time")))
        return F.struct(_s("S", (e.event_id + 7 * j) % 45).alias("stop_id"), (k % 40).cast("int").alias("stop_sequence"),
                        arrival.alias("arrival"), departure.alias("departure"))

    trip = F.struct(
        F.concat(F.when(e.event_id % 13 == 0, F.lit("X")).otherwise(F.lit("T")), e.user_id.cast("string")).alias("trip_id"),
        F.when(e.event_id % 11 == 0, F.lit(None).cast("string")).otherwise(_s("F", e.user_id % N_ROUTES)).alias("route_id"))
    vehicle = F.when(e.event_id % 9 == 0, F.lit(None).cast("struct<id:string>")).otherwise(F.struct(
        F.when(e.event_id % 17 == 0, F.lit("")).otherwise(_s("V", e.user_id)).alias("id")))
    stu = F.slice(F.array(su(0), su(1), su(2)), 1, (e.event_id % 4).cast("int"))
    return e.select(e.event_id.cast("string").alias("entity_id"), ts.alias("feed_ts"),
                    F.struct(trip.alias("trip"), vehicle.alias("vehicle"),
                             F.when(e.event_id % 2 == 0, e.value - 100.0).alias("delay"),
                             stu.alias("stop_time_update")).alias("trip_update"))
