"""GTFS-RT trip updates (decoded, nested) reduced to one delay record per
trip update entity, restricted to the city's stops."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.buckets import trip_status
from ..functions.numeric import round_metric
from ..params import MAX_RECORDS_PER_POLL


def _stop_delay(su):
    arr, dep = su["arrival"], su["departure"]
    return F.when(arr.isNotNull() & arr["delay"].isNotNull(), arr["delay"]) \
        .when(dep.isNotNull() & dep["delay"].isNotNull(), dep["delay"])


def _event_time(su):
    arr, dep = su["arrival"], su["departure"]
    return F.when(arr.isNotNull() & arr["time"].isNotNull(), arr["time"]) \
        .when(dep.isNotNull() & dep["time"].isNotNull(), dep["time"])


def reduce_trip_updates(feed: DataFrame, city_stops: DataFrame, trip_routes: DataFrame) -> DataFrame:
    """feed: entity_id, trip_update{trip{trip_id, route_id}, vehicle{id}, delay,
    stop_time_update[]{stop_id, stop_sequence, arrival{delay,time}, departure{delay,time}}}, feed_ts.

    Per entity of a feed message (an entity id is unique only inside one): among stop updates at city stops with a delay (arrival before
    departure), the one with the largest |delay| (first in feed order on
    ties); otherwise, with a trip-level delay, the first city stop update.
    """
    stops = city_stops.select("stop_id").distinct()
    # one row per stop update at a city stop, entity attributes carried along;
    # an entity without such a row can produce no record, so nothing is lost
    ex = feed.select("entity_id", "feed_ts", "trip_update.trip", "trip_update.vehicle",
                     F.col("trip_update.delay").alias("trip_delay"),
                     F.posexplode("trip_update.stop_time_update").alias("pos", "su"))
    ex = ex.withColumn("stop_id", F.col("su.stop_id")).join(stops, "stop_id", "left_semi") \
        .withColumn("sd", _stop_delay(F.col("su")))
    # a single aggregation per entity: the largest |delay| (first on ties) and the first city stop
    j = ex.groupBy("feed_ts", "entity_id").agg(
        F.min(F.when(F.col("sd").isNotNull(), F.struct((-F.abs(F.col("sd"))).alias("k"), F.col("pos"),
                                                       F.col("su"), F.col("sd")))).alias("b"),
        F.min(F.struct(F.col("pos"), F.col("su"))).alias("f"),
        *[F.any_value(c).alias(c) for c in ("trip", "vehicle", "trip_delay")])
    use_best = F.col("b").isNotNull()
    su = F.when(use_best, F.col("b.su")).otherwise(F.col("f.su"))
    delay = F.when(use_best, F.col("b.sd")).otherwise(F.col("trip_delay"))
    rec = j.where(use_best | F.col("trip_delay").isNotNull()) \
        .select("entity_id", "feed_ts", "trip", "vehicle", su.alias("su"), delay.cast("double").alias("delay"))
    t = _event_time(F.col("su"))
    feed_us = F.unix_micros(F.col("feed_ts"))
    delay_us = F.round(F.col("delay") * 1e6).cast("long")
    scheduled = F.when(t.isNotNull() & (t != 0), F.timestamp_seconds(F.floor(t - F.col("delay")))) \
        .otherwise(F.timestamp_seconds(F.floor(feed_us / 1e6)))
    actual = F.when(t.isNotNull() & (t != 0), F.timestamp_seconds(t)) \
        .otherwise(F.timestamp_seconds(F.floor((feed_us + delay_us) / 1e6)))
    routes = trip_routes.select("trip_id", F.col("route_id").alias("_mapped_route"))
    rec = rec.withColumn("trip_id", F.col("trip.trip_id")).join(routes, "trip_id", "left")
    veh = F.col("vehicle.id")
    return rec.select(
        "trip_id",
        F.coalesce(F.col("_mapped_route"), F.col("trip.route_id"), F.lit("")).alias("route_id"),
        F.when(F.col("vehicle").isNotNull() & veh.isNotNull() & (veh != ""), veh)
         .otherwise(F.concat(F.lit("rt-"), F.col("entity_id"))).alias("vehicle_id"),
        F.col("su.stop_id").alias("stop_id"), F.col("su.stop_sequence").cast("int").alias("stop_sequence"),
        scheduled.alias("scheduled_arrival_utc"), actual.alias("actual_arrival_utc"),
        round_metric(F.col("delay"), 1).alias("delay_seconds"), trip_status(F.col("delay")).alias("status"),
        F.col("feed_ts").alias("event_ts"), "entity_id")


def cap_per_poll(records: DataFrame, poll_col: str = "poll_id", cap: int = MAX_RECORDS_PER_POLL) -> DataFrame:
    """Keep the ``cap`` records with the largest |delay| per poll (a top-k
    per group: Spark applies the limit per map task before the shuffle)."""
    ties = [c for c in ("entity_id", "event_ts") if c in records.columns]
    w = Window.partitionBy(poll_col).orderBy(F.desc(F.abs(F.col("delay_seconds"))), *ties)
    return records.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn")
