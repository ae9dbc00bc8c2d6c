"""Live-window analytics: what a dashboard shows from the newest records of
the raw streams (latest row per vehicle / zone / event, the last N trip
updates), computed as DataFrame jobs over the Bronze tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.buckets import live_proximity_bucket
from ..functions.geo import equirect_km, sq_deg_dist
from ..functions.numeric import pct, round_metric
from ..operators.aggregates import nearest_rank, weighted_nearest_rank
from ..operators.dedup import latest_per_key
from ..session import cut_lineage, materialise
from ..params import LIVE_RECENT_ROWS, ON_TIME_THRESHOLD_SECONDS as ON_TIME, SEVERE_DELAY_THRESHOLD_SECONDS as SEVERE


def _since(df: DataFrame, since) -> DataFrame:
    """Optional lower time bound: on date-partitioned layers the filter prunes
    whole partitions, so a dashboard does not scan the full history."""
    if since is None:
        return df
    at = F.lit(since).cast("timestamp")
    if "service_date" in df.columns:  # the layers' partition column
        df = df.where(F.col("service_date") >= F.to_date(at))
    return df.where(F.col("event_ts") >= at)


def latest_positions(positions: DataFrame, since=None) -> DataFrame:
    return latest_per_key(_since(positions, since).where(F.col("vehicle_id").isNotNull()), ["vehicle_id"], "event_ts")


def latest_weather(weather: DataFrame, since=None) -> DataFrame:
    return latest_per_key(_since(weather, since).where(F.col("zone_id").isNotNull()), ["zone_id"], "event_ts")


def latest_events(events: DataFrame, since=None) -> DataFrame:
    return latest_per_key(_since(events, since).where(F.col("event_id").isNotNull()), ["event_id"], "event_ts")


def active_events(events: DataFrame, since=None) -> DataFrame:
    return latest_events(events, since).where(F.col("status") == "ACTIVE")


def recent_updates(trip_updates: DataFrame, n: int = LIVE_RECENT_ROWS, since=None) -> DataFrame:
    """The last ``n`` trip updates by event time (a top-k, bounded by n: each
    task keeps its own top n before one merge); a missing delay counts as 0."""
    newest = [F.desc(c) for c in ("event_ts", "trip_id", "stop_id", "ingested_ts") if c in trip_updates.columns]
    top = _since(trip_updates, since).orderBy(*newest).limit(n)
    return top.withColumn("d", F.coalesce(F.col("delay_seconds").cast("double"), F.lit(0.0)))


def live_window(trip_updates: DataFrame, n: int = LIVE_RECENT_ROWS, since=None) -> DataFrame:
    """The live window materialised once (at most ``n`` rows, a reliable
    checkpoint in the shared folder), for plans that read it more than once:
    each reuse is a scan of n rows, not another top-k over the full stream."""
    return cut_lineage(recent_updates(trip_updates, n, since))


def window_positions(window: DataFrame, positions: DataFrame) -> DataFrame:
    """Latest position (``p_lat``, ``p_lon``) of only the vehicles in the live
    window. The window is a top-n, so its vehicle ids have a proven bound and
    are broadcast as a semi-join filter on the position stream; the
    latest-per-key aggregation then shuffles at most n keys instead of every
    vehicle in history."""
    ids = F.broadcast(window.select("vehicle_id").where(F.col("vehicle_id").isNotNull()))
    return latest_positions(positions.join(ids, "vehicle_id", "left_semi")) \
        .select("vehicle_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))


def _delay_stats(g, p95: bool = True):
    n = F.count(F.lit(1))
    cols = [round_metric(F.avg("d")).alias("avg_delay_seconds")]
    if p95:
        cols.append(round_metric(nearest_rank("d", 0.95)).alias("p95_delay_seconds"))
    cols += [n.alias("observations"), pct(F.count_if(F.col("d") <= ON_TIME), n).alias("on_time_pct")]
    return g.agg(*cols)


def top_routes(trip_updates: DataFrame, limit: int = 10) -> DataFrame:
    stats = _delay_stats(recent_updates(trip_updates).groupBy("route_id"))
    return stats.orderBy(F.desc("avg_delay_seconds"), "route_id").limit(limit)


def delay_trends(trip_updates: DataFrame, hours: int = 24) -> DataFrame:
    r = recent_updates(trip_updates).where(F.col("event_ts").isNotNull())
    stats = _delay_stats(r.groupBy(F.date_format("event_ts", "yyyy-MM-dd'T'HH:00:00").alias("bucket")), p95=False)
    return stats.orderBy(F.desc("bucket")).limit(hours).orderBy("bucket")


def _num(c):
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))


def hotspots(positions: DataFrame, limit: int = 20) -> DataFrame:
    lp = latest_positions(positions).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    lat, lon = round_metric("lat"), round_metric("lon")
    cells = lp.select(F.concat(lat.cast("string"), F.lit("|"), lon.cast("string")).alias("grid_cell"),
                      lat.alias("lat"), lon.alias("lon"), _num("delay_seconds").alias("d"),
                      _num("speed_kmh").alias("s"), _num("congestion_level").alias("c"))
    agg = cells.groupBy("grid_cell", "lat", "lon").agg(
        round_metric(F.avg("d")).alias("avg_delay_seconds"), round_metric(F.avg("s")).alias("avg_speed_kmh"),
        round_metric(F.avg("c"), 3).alias("avg_congestion"), F.count(F.lit(1)).alias("vehicles"))
    return agg.orderBy(F.desc("avg_delay_seconds"), "grid_cell").limit(limit)


def kpis(positions: DataFrame, events: DataFrame) -> DataFrame:
    lp = latest_positions(positions).select(_num("delay_seconds").alias("d"), _num("speed_kmh").alias("s"))
    n = F.count(F.lit(1))
    k = lp.agg(n.alias("vehicles_tracked"),
               F.coalesce(round_metric(F.avg("d")), F.lit(0.0)).alias("avg_delay_seconds"),
               F.coalesce(pct(F.count_if(F.col("d") <= ON_TIME), n), F.lit(100.0)).alias("on_time_pct"),
               F.count_if(F.col("d") > SEVERE).alias("severe_delays"),
               F.coalesce(round_metric(F.avg("s")), F.lit(0.0)).alias("avg_speed_kmh"))
    return k.withColumn("active_events", active_events(events).select(F.count(F.lit(1))).scalar())


def _nearest_zone_condition(located: DataFrame, zones: DataFrame) -> DataFrame:
    """(_id, nearest) of at most LIVE_RECENT_ROWS located rows: every zone is compared with the rows of the window,
    which travel as one array of proven length, and the smallest distance is taken map-side first."""
    window = located.select(F.collect_list(F.struct("_id", "p_lat", "p_lon"))).scalar()
    pairs = zones.withColumn("_window", window).select("zone_id", "condition", "lat", "lon", F.explode("_window").alias("w"))
    best = F.min(F.struct(sq_deg_dist(F.col("w.p_lat"), F.col("w.p_lon"), F.col("lat"), F.col("lon")).alias("d"),
                          "zone_id", F.col("condition").alias("c")))
    return pairs.groupBy(F.col("w._id").alias("_id")).agg(best.alias("_b")).select("_id", F.col("_b.c").alias("nearest"))


def _own_or_position(r: DataFrame, pos: DataFrame) -> DataFrame:
    """Coordinates for an update: its own lat/lon when the stream carries them,
    else the latest position of its vehicle (``p_lat``/``p_lon``)."""
    r = r.join(pos, "vehicle_id", "left")
    if "lat" in r.columns and "lon" in r.columns:
        own = F.col("lat").isNotNull()
        r = r.withColumn("p_lat", F.when(own, F.col("lat")).otherwise(F.col("p_lat"))) \
             .withColumn("p_lon", F.when(own, F.col("lon")).otherwise(F.col("p_lon")))
    return r


def weather_impact(trip_updates: DataFrame, positions: DataFrame, weather: DataFrame) -> DataFrame:
    """Condition per recent update: its own condition when present, else the
    nearest zone (squared degrees) to its own coordinates or, lacking those,
    to its vehicle's latest position; 'unknown' without any."""
    zones = latest_weather(weather).where(F.col("lat").isNotNull() & F.col("lon").isNotNull()) \
        .select("lat", "lon", "zone_id", "condition")
    window = live_window(trip_updates)
    r = cut_lineage(_own_or_position(window, window_positions(window, positions)).withColumn(
        "_id", F.monotonically_increasing_id()))
    located = r.where(F.col("p_lat").isNotNull() & F.col("p_lon").isNotNull())
    r = r.join(_nearest_zone_condition(located, zones), "_id", "left")
    nearest = F.when(F.col("nearest").isNull() | (F.col("nearest") == ""), F.lit("unknown")).otherwise(F.col("nearest"))
    own = F.col("condition") if "condition" in trip_updates.columns else F.lit(None).cast("string")
    cond = F.when(own.isNotNull() & (own != ""), own).otherwise(nearest)
    return _delay_stats(r.withColumn("_condition", cond).drop("condition")
                        .withColumnRenamed("_condition", "condition").groupBy("condition"), p95=False)


def route_reliability(trip_updates: DataFrame, positions: DataFrame, limit: int = 25) -> DataFrame:
    n = F.count(F.lit(1))
    stats = recent_updates(trip_updates).groupBy("route_id").agg(
        round_metric(F.avg("d")).alias("avg_delay_seconds"),
        round_metric(nearest_rank("d", 0.95)).alias("p95_delay_seconds"),
        pct(F.count_if(F.col("d") <= ON_TIME), n).alias("on_time_pct"),
        pct(F.count_if(F.col("d") > SEVERE), n).alias("severe_pct"),
        n.alias("stops_observed"))
    modes = latest_positions(positions).groupBy("route_id").agg(
        F.max_by("route_mode", F.struct("event_ts", "vehicle_id")).alias("_mode"))
    out = stats.join(modes, "route_id", "left").withColumn("route_mode", F.coalesce("_mode", F.lit("unknown")))
    return out.drop("_mode").orderBy(F.desc("avg_delay_seconds"), "route_id").limit(limit)


def events_impact(trip_updates: DataFrame, positions: DataFrame, events: DataFrame,
                  km_per_deg: float = 111.0, lon_scale: float = 0.7) -> DataFrame:
    """Delay of recent updates by distance of the vehicle to every active
    event: one observation per (event, update).

    The live distance is Euclidean in a plane scaled to km (111 km per degree
    of latitude, 0.7 of that per degree of longitude). Events are put into
    5 km grid cells; an update probes the 3x3 cells around it, which hold
    every event within 5 km, so only near pairs are formed (an equi-join on
    the cell). 'far' is the number of active events minus the near ones,
    and the percentile runs on (delay, weight) rows.
    """
    cell_km = 5.0 + 1e-3  # a margin so float noise cannot push a 5 km event out of the 3x3 block
    act = active_events(events).where(F.col("lat").isNotNull() & F.col("lon").isNotNull()) \
        .select(F.col("lat").alias("e_lat"), F.col("lon").alias("e_lon"))
    n_events = act.select(F.count(F.lit(1))).scalar()
    ev = act.select("e_lat", "e_lon",
                    F.floor(F.col("e_lat") * km_per_deg / cell_km).alias("cy"),
                    F.floor(F.col("e_lon") * km_per_deg * lon_scale / cell_km).alias("cx"))
    window = live_window(trip_updates)
    # the vehicle's latest position, else the update's own coordinates
    r = window.join(window_positions(window, positions), "vehicle_id", "left")
    if "lat" in trip_updates.columns and "lon" in trip_updates.columns:
        has_pos = F.col("p_lat").isNotNull()
        r = r.withColumn("p_lon", F.when(has_pos, F.col("p_lon")).otherwise(F.col("lon"))) \
             .withColumn("p_lat", F.when(has_pos, F.col("p_lat")).otherwise(F.col("lat")))
    # at most n rows, read by the probes and the per-update counts: materialised once, each with an id of its own
    # (the raw stream may hold one update several times)
    r = cut_lineage(r.where(F.col("p_lat").isNotNull() & F.col("p_lon").isNotNull())
                    .select(F.monotonically_increasing_id().alias("_id"), "d", "p_lat", "p_lon"))
    offsets = F.array(*[F.struct(F.lit(i).alias("dy"), F.lit(j).alias("dx")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    probes = r.select("*", F.explode(offsets).alias("o")).select(
        "_id", "d", "p_lat", "p_lon",
        (F.floor(F.col("p_lat") * km_per_deg / cell_km) + F.col("o.dy")).alias("cy"),
        (F.floor(F.col("p_lon") * km_per_deg * lon_scale / cell_km) + F.col("o.dx")).alias("cx"))
    km = equirect_km(F.col("p_lat"), F.col("p_lon"), F.col("e_lat"), F.col("e_lon"), km_per_deg, lon_scale)
    bucket = live_proximity_bucket(km)
    near = probes.join(ev, ["cy", "cx"]).select("_id", bucket.alias("b")).groupBy("_id").agg(
        F.count_if(F.col("b") == "within_2km").alias("n2"), F.count_if(F.col("b") == "within_5km").alias("n5"))
    per = cut_lineage(r.join(near, "_id", "left").fillna(0, ["n2", "n5"])
                      .withColumn("nf", n_events - F.col("n2") - F.col("n5")))
    counts = F.array(F.struct(F.lit("within_2km").alias("proximity_bucket"), F.col("n2").alias("w")),
                     F.struct(F.lit("within_5km").alias("proximity_bucket"), F.col("n5").alias("w")),
                     F.struct(F.lit("far").alias("proximity_bucket"), F.col("nf").alias("w")))
    rows = per.select("d", F.explode(counts).alias("b")).select("b.proximity_bucket", "d", F.col("b.w").alias("w")) \
        .where(F.col("w") > 0)
    n = F.sum("w")
    stats = rows.groupBy("proximity_bucket").agg(
        n.alias("observations"), round_metric(F.sum(F.col("w") * F.col("d")) / n).alias("avg_delay_seconds"),
        pct(F.sum(F.when(F.col("d") <= ON_TIME, F.col("w")).otherwise(0)), n).alias("on_time_pct"))
    p95 = weighted_nearest_rank(rows, ["proximity_bucket"], "d", "w", 0.95, "_p95")
    return stats.join(p95, "proximity_bucket").select(
        "proximity_bucket", "observations", "avg_delay_seconds", round_metric("_p95").alias("p95_delay_seconds"),
        "on_time_pct", F.lit(0.0).alias("avg_event_impact"))


def current_delays(positions: DataFrame, limit: int = 200) -> DataFrame:
    """Latest position per vehicle, largest delay first (NULL as 0), the
    first ``limit`` rows, each carrying the total vehicle count."""
    lp = materialise(latest_positions(positions).select(  # once, for the rows and their number
        "vehicle_id", "route_id", "route_mode", "lat", "lon", "speed_kmh", "delay_seconds", "congestion_level", "event_ts"), "latest")
    total = lp.select(F.count(F.lit(1))).scalar()
    return lp.orderBy(F.desc(F.coalesce(F.col("delay_seconds"), F.lit(0.0))), "vehicle_id").limit(limit) \
        .withColumn("vehicle_count", total)


def weather_current(weather: DataFrame) -> DataFrame:
    """Latest observation per zone, newest first; the newest is the city headline."""
    lw = latest_weather(weather)
    newest_first = [F.desc_nulls_last("event_ts"), F.asc("zone_id")]
    headline = lw.orderBy(*newest_first).limit(1).select("zone_id").scalar()
    return lw.withColumn("is_headline", F.col("zone_id") == headline).orderBy(*newest_first)


def ingest_counters(streams: dict[str, DataFrame]) -> DataFrame:
    """Records and rate per stream over the observed span (first to last
    ingest time)."""
    parts = [df.select(F.lit(name).alias("stream"), F.col("ingested_ts")) for name, df in streams.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    g = u.groupBy("stream").agg(F.count(F.lit(1)).alias("records"),
                                ((F.unix_micros(F.max("ingested_ts")) - F.unix_micros(F.min("ingested_ts")))
                                 / 1e6).alias("_span"))
    return g.select("stream", "records",
                    round_metric(F.col("records") / F.greatest(F.col("_span"), F.lit(1.0))).alias("rate_per_s"))
