"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame over the whole
input tables. Floating outputs that come from transcendental functions or
unordered sums are reported rounded to 6 decimals (``REPORT_DIGITS``) in
both engines, so that the comparison does not depend on summation order.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import oracle as O
from .functions.numeric import round_metric
from .params import CityProfile
from .plans import marts
from .plans.warehouse import Warehouse

REPORT_DIGITS = 6
_WH_CACHE: dict = {}


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _WH_CACHE:
        _WH_CACHE.clear()
        _WH_CACHE[key] = Warehouse.from_fixture(spark, sf_dir)
    return _WH_CACHE[key]


def report(df: DataFrame, cols: list[str], digits: int = REPORT_DIGITS) -> DataFrame:
    return df.withColumns({c: round_metric(c, digits) for c in cols})


def _r6(cols):
    return ", ".join(f"{O.R(c, REPORT_DIGITS)} AS {c}" for c in cols)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


FACT_FLOATS = ["segment_km", "event_proximity_km", "historical_avg_delay"]
FACT_COLS = ("trip_id, route_id, vehicle_id, stop_id, stop_sequence, delay_seconds, delay_bucket, status, event_ts, "
             "hour_of_day, day_of_week, is_rush_hour, route_mode, stop_zone_num, weather_zone_id, temperature_c, "
             "precipitation_mm, wind_speed_kmh, humidity_pct, condition, nearest_event_impact, event_nearby")


# ---------------------------------------------------------------- silver layer
@register("silver_transport_positions", O.with_layers("SELECT * FROM silver_positions"))
def q_silver_positions(spark, sf):
    return wh(spark, sf).silver_positions


OTHER_CITY = CityProfile("Potsdam", 52.40, 13.06, {"lat_min": 52.33, "lat_max": 52.47, "lon_min": 12.9, "lon_max": 13.3})


@register("silver_positions_other_city", O.with_layers("SELECT * FROM silver_positions").replace(
    "lat BETWEEN 52.35 AND 52.68 AND lon BETWEEN 13.08 AND 13.75", "lat BETWEEN 52.33 AND 52.47 AND lon BETWEEN 12.9 AND 13.3"))
def q_silver_other_city(spark, sf):
    """Silver positions of another active city: its profile's bounds decide."""
    return Warehouse.from_fixture(spark, sf, city=OTHER_CITY).silver_positions


@register("silver_trip_updates", O.with_layers("SELECT * FROM silver_tu"))
def q_silver_tu(spark, sf):
    return wh(spark, sf).silver_trip_updates


@register("silver_weather_observations", O.with_layers("SELECT * FROM silver_weather"))
def q_silver_weather(spark, sf):
    return wh(spark, sf).silver_weather


@register("silver_city_events", O.with_layers("SELECT * FROM silver_cev"))
def q_silver_events(spark, sf):
    return wh(spark, sf).silver_events


@register("stg_weather_hourly", O.with_layers("SELECT * FROM wh"))
def q_weather_hourly(spark, sf):
    return wh(spark, sf).weather_hourly


@register("dim_stops", O.with_layers("SELECT * FROM dim_stops"))
def q_dim_stops(spark, sf):
    return wh(spark, sf).dim_stops


@register("stop_segments", O.with_layers(f"SELECT trip_id, stop_id, stop_sequence, {_r6(['segment_km'])} FROM segments"))
def q_segments(spark, sf):
    from .operators.joins import stop_segments
    w = wh(spark, sf)
    return report(stop_segments(w.dim_stop_times, w.dim_stops), ["segment_km"])


@register("route_length_km", O.with_layers(
    f"SELECT trip_id, count(*) AS stops, {O.R('sum(segment_km)', 6)} AS route_km FROM segments GROUP BY 1"))
def q_route_length(spark, sf):
    from .operators.joins import stop_segments
    w = wh(spark, sf)
    seg = stop_segments(w.dim_stop_times, w.dim_stops)
    return seg.groupBy("trip_id").agg(F.count(F.lit(1)).alias("stops"),
                                      round_metric(F.sum("segment_km"), 6).alias("route_km"))


@register("nearest_active_event", O.with_layers(
    f"SELECT trip_id, stop_id, event_ts, {_r6(['event_proximity_km'])}, nearest_impact, nearest_event_id FROM ei"))
def q_nearest(spark, sf):
    from .operators.nearest import nearest_active_event
    w = wh(spark, sf)
    pts = w.stg_trip_updates.join(w.dim_stops.select("stop_id", "stop_lat", "stop_lon"), "stop_id")
    return report(nearest_active_event(pts, w.stg_events, ["trip_id", "stop_id", "event_ts"]), ["event_proximity_km"])


@register("route_stop_avg", O.with_layers(f"SELECT route_id, stop_id, {_r6(['historical_avg_delay'])} FROM rsa"))
def q_rsa(spark, sf):
    from .plans.facts import route_stop_avg
    return report(route_stop_avg(wh(spark, sf).stg_trip_updates), ["historical_avg_delay"])


# ----------------------------------------------------------------------- facts
@register("fct_trip_delays", O.with_layers(f"SELECT {FACT_COLS}, {_r6(FACT_FLOATS)} FROM fct"))
def q_fct_trip_delays(spark, sf):
    return report(wh(spark, sf).fct_trip_delays, FACT_FLOATS)


@register("fct_vehicle_positions", O.with_layers("SELECT * FROM fvp"))
def q_fvp(spark, sf):
    return wh(spark, sf).fct_vehicle_positions


@register("ml_features", O.with_layers(
    "SELECT trip_id, route_id, stop_id, delay_seconds, hour_of_day, day_of_week, is_rush_hour, route_mode, "
    "stop_zone_num, temperature_c, precipitation_mm, wind_speed_kmh, humidity_pct, condition, event_nearby, event_ts, "
    f"{_r6(['segment_km', 'event_proximity_km', 'historical_avg_delay'])} FROM fct WHERE delay_seconds >= -120"))
def q_ml_features(spark, sf):
    return report(wh(spark, sf).ml_features, ["segment_km", "event_proximity_km", "historical_avg_delay"])


# ----------------------------------------------------------------------- marts
@register("mart_route_reliability", O.with_layers("SELECT * FROM mart_rr"))
def q_mart_rr(spark, sf):
    return wh(spark, sf).mart_route_reliability


@register("mart_delay_trends", O.with_layers("SELECT * FROM mart_trends"))
def q_mart_trends(spark, sf):
    return wh(spark, sf).mart_delay_trends


@register("mart_congestion_hotspots", O.with_layers("SELECT * FROM mart_hot"))
def q_mart_hot(spark, sf):
    return wh(spark, sf).mart_congestion_hotspots


@register("mart_weather_impact", O.with_layers("SELECT * FROM mart_wi"))
def q_mart_wi(spark, sf):
    return wh(spark, sf).mart_weather_impact


@register("mart_events_impact", O.with_layers("SELECT * FROM mart_ei"))
def q_mart_ei(spark, sf):
    return wh(spark, sf).mart_events_impact


@register("kpis", O.with_layers(
    f"SELECT count(*) AS observations, {O.R('avg(delay_seconds)')} AS avg_delay_seconds, "
    f"{O.PCT(chr(39).join(['count_if(delay_bucket = ', 'on_time', ')']))} AS on_time_pct, "
    "CAST(count_if(delay_bucket = 'severe') AS BIGINT) AS severe_delays FROM fct"))
def q_kpis(spark, sf):
    return marts.kpis(wh(spark, sf).fct_without_events)


@register("test_reliability_score_range", O.with_layers(
    "SELECT route_id, service_date, reliability_score FROM mart_rr WHERE reliability_score < 0 OR reliability_score > 100"))
def q_test_score(spark, sf):
    return marts.reliability_score_out_of_range(wh(spark, sf).mart_route_reliability)


@register("test_severe_delay_share", O.with_layers(
    "SELECT route_id, CAST(event_ts AS DATE) AS service_date, count(*) AS total, "
    "CAST(count_if(delay_bucket = 'severe') AS BIGINT) AS severe FROM fct GROUP BY 1, 2 "
    "HAVING count_if(delay_bucket = 'severe') > 0.35 * count(*)"))
def q_test_severe(spark, sf):
    return marts.severe_share_violations(wh(spark, sf).fct_without_events)


# ---------------------------------------------------------------- read queries
@register("top_routes", O.with_layers(
    "SELECT route_id, route_mode, service_date, avg_delay_seconds, p95_delay_seconds, on_time_pct, severe_pct, "
    "stops_observed FROM mart_rr ORDER BY avg_delay_seconds DESC, route_id, service_date LIMIT 10"))
def q_top_routes(spark, sf):
    return marts.top_routes(wh(spark, sf).mart_route_reliability, 10)


@register("latest_trends", O.with_layers(
    "SELECT service_date, hour_of_day, observations, avg_delay_seconds, on_time_pct, severe_pct FROM mart_trends "
    "ORDER BY service_date DESC, hour_of_day DESC LIMIT 24"))
def q_latest_trends(spark, sf):
    return marts.latest_trends(wh(spark, sf).mart_delay_trends, 24)


@register("top_hotspots", O.with_layers(
    "SELECT grid_cell, cell_lat AS lat, cell_lon AS lon, avg_delay_seconds, avg_speed_kmh, avg_congestion, vehicles, "
    "severe_pct, congestion_rank FROM mart_hot ORDER BY congestion_rank LIMIT 25"))
def q_top_hotspots(spark, sf):
    return marts.top_hotspots(wh(spark, sf).mart_congestion_hotspots, 25)


@register("reliability_listing", O.with_layers(
    "SELECT route_id, route_mode, service_date, trips, stops_observed, on_time_pct, reliability_score, "
    "avg_delay_seconds, p95_delay_seconds FROM mart_rr"))
def q_rel_listing(spark, sf):
    return marts.reliability_listing(wh(spark, sf).mart_route_reliability)


@register("weather_impact_listing", O.with_layers("SELECT * FROM mart_wi"))
def q_wi_listing(spark, sf):
    return marts.weather_impact_listing(wh(spark, sf).mart_weather_impact)


@register("events_impact_listing", O.with_layers("SELECT * FROM mart_ei"))
def q_ei_listing(spark, sf):
    return marts.events_impact_listing(wh(spark, sf).mart_events_impact)


def queries() -> dict:
    return {k: v[0] for k, v in QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v[1] for k, v in QUERIES.items() if v[1] is not None}


# ------------------------------------------------------------ live window
def _bronze(spark, sf):
    return wh(spark, sf).bronze


def _live(name):
    return O.LIVE_SQL[name]


@register("live_top_routes", _live("live_top_routes"))
def q_live_top_routes(spark, sf):
    from .plans import live
    return live.top_routes(_bronze(spark, sf)["trip_updates"])


@register("live_delay_trends", _live("live_delay_trends"))
def q_live_trends(spark, sf):
    from .plans import live
    return live.delay_trends(_bronze(spark, sf)["trip_updates"])


@register("live_hotspots", _live("live_hotspots"))
def q_live_hotspots(spark, sf):
    from .plans import live
    return live.hotspots(_bronze(spark, sf)["transport_positions"])


@register("live_kpis", _live("live_kpis"))
def q_live_kpis(spark, sf):
    from .plans import live
    b = _bronze(spark, sf)
    return live.kpis(b["transport_positions"], b["city_events"])


@register("live_weather_impact", _live("live_weather_impact"))
def q_live_weather(spark, sf):
    from .plans import live
    b = _bronze(spark, sf)
    return live.weather_impact(b["trip_updates"], b["transport_positions"], b["weather_observations"])


@register("live_route_reliability", _live("live_route_reliability"))
def q_live_rel(spark, sf):
    from .plans import live
    b = _bronze(spark, sf)
    return live.route_reliability(b["trip_updates"], b["transport_positions"])


@register("live_events_impact", _live("live_events_impact"))
def q_live_events(spark, sf):
    from .plans import live
    b = _bronze(spark, sf)
    return live.events_impact(b["trip_updates"], b["transport_positions"], b["city_events"])


@register("live_current_delays", _live("live_current_delays"))
def q_live_current(spark, sf):
    from .plans import live
    return live.current_delays(_bronze(spark, sf)["transport_positions"])


@register("live_window_updates", O.with_live(
    "SELECT * FROM a_tu ORDER BY event_ts DESC NULLS LAST, trip_id DESC NULLS LAST, stop_id DESC NULLS LAST, ingested_ts DESC LIMIT 5000"))
def q_live_window(spark, sf):
    """All updates that the live window holds."""
    from .params import LIVE_WINDOW_ROWS
    from .plans import live
    return live.recent_updates(_bronze(spark, sf)["trip_updates"], LIVE_WINDOW_ROWS).drop("d")


@register("live_weather_current", _live("live_weather_current"))
def q_live_weather_current(spark, sf):
    from .plans import live
    return live.weather_current(_bronze(spark, sf)["weather_observations"])


@register("latest_event_state", _live("latest_event_state"))
def q_latest_event_state(spark, sf):
    from .plans import live
    return live.latest_events(_bronze(spark, sf)["city_events"])


@register("ingest_counters", _live("ingest_counters"))
def q_ingest_counters(spark, sf):
    from .plans import live
    return live.ingest_counters(_bronze(spark, sf))


# ------------------------------------------------------------ GTFS extraction
CITY_RADIUS_KM = 5.0  # a centre cut, so the box actually drops stops of the fixture network


def _city(spark, sf):
    from .plans.gtfs_extract import extract_city
    g = wh(spark, sf).gtfs
    return extract_city(g["stops"], g["stop_times"], g["trips"], g["routes"], radius_km=CITY_RADIUS_KM)


@register("gtfs_city_stops", O.with_live(O.gtfs_city_sql(CITY_RADIUS_KM) + "SELECT * FROM city_stops"))
def q_city_stops(spark, sf):
    return _city(spark, sf).stops


@register("gtfs_city_stop_times", O.with_live(O.gtfs_city_sql(CITY_RADIUS_KM) + "SELECT * FROM city_st"))
def q_city_st(spark, sf):
    return _city(spark, sf).stop_times


@register("gtfs_city_trips", O.with_live(O.gtfs_city_sql(CITY_RADIUS_KM) + "SELECT * FROM city_trips"))
def q_city_trips(spark, sf):
    return _city(spark, sf).trips


@register("gtfs_city_routes", O.with_live(O.gtfs_city_sql(CITY_RADIUS_KM) + "SELECT * FROM city_routes"))
def q_city_routes(spark, sf):
    return _city(spark, sf).routes


@register("gtfs_city_counts", O.with_live(O.gtfs_city_sql(CITY_RADIUS_KM) + """
SELECT 'stops' AS table_name, count(*) AS "rows" FROM city_stops UNION ALL
SELECT 'stop_times', count(*) FROM city_st UNION ALL SELECT 'trips', count(*) FROM city_trips UNION ALL
SELECT 'routes', count(*) FROM city_routes"""))
def q_city_counts(spark, sf):
    return _city(spark, sf).counts()


@register("gtfs_routes_loaded", O.with_layers(
    "SELECT route_id, route_mode, 'DE' AS agency_id, "
    "CAST(CASE route_mode WHEN 'rail' THEN 2 WHEN 'tram' THEN 0 WHEN 'bus' THEN 3 END AS INTEGER) AS route_type "
    "FROM a_routes"))
def q_routes_loaded(spark, sf):
    """Loader rule: constant agency, route_type from route_mode."""
    from .operators.dims import assign_route_type
    g = wh(spark, sf).gtfs
    r = g["routes"].select("route_id", "route_mode")
    return assign_route_type(r).select("route_id", "route_mode", "agency_id", "route_type")


@register("representative_trips", O.with_layers("""
, pick AS (SELECT route_id, trip_id FROM a_trips
           QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY direction_id <> 0, trip_id) = 1),
n AS (SELECT trip_id, count(*) AS n_stops FROM a_stop_times GROUP BY 1)
SELECT p.trip_id, p.route_id, n.n_stops, r.route_mode, {len} AS length_km
FROM pick p JOIN n ON n.trip_id = p.trip_id LEFT JOIN a_routes r ON r.route_id = p.route_id
LEFT JOIN (SELECT trip_id, sum(segment_km) AS length_km FROM segments GROUP BY 1) l ON l.trip_id = p.trip_id
WHERE n.n_stops >= 2""".replace("{len}", O.R("l.length_km", 6))))
def q_rep_trips(spark, sf):
    from .plans.gtfs_extract import representative_trips, route_lengths
    w = wh(spark, sf)
    rep = representative_trips(w.dim_trips, w.dim_stop_times, w.dim_routes)
    return report(route_lengths(rep, w.dim_stop_times, w.dim_stops), ["length_km"])


@register("trip_stop_sequence", O.with_layers(
    "SELECT st.trip_id, row_number() OVER (PARTITION BY st.trip_id ORDER BY st.stop_sequence, st.stop_id) AS position, "
    "st.stop_sequence, st.stop_id, s.stop_lat, s.stop_lon FROM a_stop_times st JOIN a_stops s ON s.stop_id = st.stop_id"))
def q_trip_stop_sequence(spark, sf):
    from .plans.gtfs_extract import ordered_stops
    w = wh(spark, sf)
    return ordered_stops(w.dim_stop_times, w.dim_stops)


# --------------------------------------------------------------- GTFS realtime
def _rt(spark, sf):
    from .plans.realtime import reduce_trip_updates
    from .sources.fixtures import gtfs_rt_feed
    w = wh(spark, sf)
    return reduce_trip_updates(gtfs_rt_feed(w.fixture.events), w.gtfs["stops"], w.gtfs["trips"])


@register("gtfs_rt_trip_updates", O.with_live(O.RT_SQL + "\nSELECT * FROM rt_out"))
def q_rt(spark, sf):
    return _rt(spark, sf)


@register("gtfs_rt_capped_polls", O.with_live(O.RT_SQL + """
SELECT * FROM rt_out
QUALIFY row_number() OVER (PARTITION BY event_ts ORDER BY abs(delay_seconds) DESC, entity_id) <= 600"""))
def q_rt_capped(spark, sf):
    """The poller's cap: the 600 largest delays of each poll (feed time)."""
    from .plans.realtime import cap_per_poll
    return cap_per_poll(_rt(spark, sf), "event_ts")


@register("gtfs_rt_capped_weeks", O.with_live(O.RT_SQL + """
SELECT *, date_trunc('week', event_ts)::TIMESTAMP AS poll FROM rt_out
QUALIFY row_number() OVER (PARTITION BY date_trunc('week', event_ts) ORDER BY abs(delay_seconds) DESC, entity_id, event_ts) <= 600"""))
def q_rt_capped_weeks(spark, sf):
    """The cap where a poll (here a week) holds more records than it lets through."""
    from .plans.realtime import cap_per_poll
    return cap_per_poll(_rt(spark, sf).withColumn("poll", F.date_trunc("week", "event_ts")), "poll")


# ------------------------------------------------------------ stored by key
@register("gtfs_city_bucketed", O.with_live(O.gtfs_city_sql(CITY_RADIUS_KM) + f"""
SELECT c.trip_id, c.stop_id, c.stop_sequence, c.arrival_time, c.departure_time, {O.R("s.segment_km", 6)} AS segment_km
FROM city_st c JOIN segments s ON s.trip_id = c.trip_id AND s.stop_id = c.stop_id AND s.stop_sequence = c.stop_sequence"""))
def q_city_bucketed(spark, sf):
    """Trips and stop times stored in buckets of trip_id: extraction and segments without a shuffle on the trip."""
    return report(_bucketed_city(spark, sf)[0], ["segment_km"])


def _bucketed_city(spark, sf):
    import uuid
    from .plans.gtfs_extract import extract_city_in_place
    from .session import checkpoint_dir
    from .sources.tables import write_bucketed
    g, name = wh(spark, sf).gtfs, f"tramline_{uuid.uuid4().hex}"
    root = f"{checkpoint_dir(spark)}/{name}"
    stored = {t: write_bucketed(g[t], f"{name}_{t}", f"{root}/{t}", "trip_id", 8) for t in ("trips", "stop_times")}
    return extract_city_in_place(g["stops"], stored["stop_times"], stored["trips"], radius_km=CITY_RADIUS_KM)


# ------------------------------------------------------------ lists through SQL text
def _list_sql(mart: str, order: str, columns: str, limit: int | None = None) -> str:
    cut = f" QUALIFY position <= {limit}" if limit else ""
    return O.with_layers(f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position, {columns} FROM {mart}{cut}")


_MART_CTE = {"mart_route_reliability": "mart_rr", "mart_delay_trends": "mart_trends", "mart_congestion_hotspots": "mart_hot",
             "mart_weather_impact": "mart_wi", "mart_events_impact": "mart_ei"}
_LIST_LIMITS = {"top_routes": 10, "latest_trends": 24, "top_hotspots": 25}


def _register_list(name: str):
    from .functions.tables import LISTS, _names
    _, mart, columns, order = LISTS[name]
    limit = _LIST_LIMITS.get(name)

    @register(f"sql_{name}", _list_sql(_MART_CTE[mart], order, _names(columns), limit))
    def q_list(spark, sf):
        """A read query through SQL text, with a bound parameter; the order is compared through the position."""
        from .functions.tables import register_lists
        register_lists(spark, {mart: getattr(wh(spark, sf), mart)}, [name])
        if limit:
            return spark.sql(f"SELECT * FROM {name}(:n)", args={"n": limit})
        return spark.sql(f"SELECT * FROM {name}()")


for _name in ("top_routes", "latest_trends", "top_hotspots", "reliability_listing", "weather_impact_listing", "events_impact_listing"):
    _register_list(_name)


@register("sql_city_positions", O.with_layers("""
, city AS (SELECT 52.40::DOUBLE + (n_nationkey % 5) * 0.05::DOUBLE AS lat0, 13.15::DOUBLE + (n_nationkey % 7) * 0.08::DOUBLE AS lon0
           FROM nation WHERE n_name = 'NATION_2')
SELECT vehicle_id, route_id, lat, lon, event_ts FROM a_pos, city
WHERE lat BETWEEN lat0 - 6.0::DOUBLE / 111.0::DOUBLE AND lat0 + 6.0::DOUBLE / 111.0::DOUBLE
  AND lon BETWEEN lon0 - 6.0::DOUBLE / (111.0::DOUBLE * greatest(cos(radians(lat0)), 0.2::DOUBLE))
              AND lon0 + 6.0::DOUBLE / (111.0::DOUBLE * greatest(cos(radians(lat0)), 0.2::DOUBLE))"""))
def q_sql_city_positions(spark, sf):
    """The catalog (JSON, read back) and the positions of one of its cities, by name and radius as bound parameters."""
    import uuid
    from .functions.tables import register_city_functions
    from .params import load_city_catalog
    from .session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/tramline-cities-{uuid.uuid4().hex}"
    key = F.col("n_nationkey")
    city = F.struct(F.col("n_name").alias("name"), (F.lit(52.40) + (key % 5) * F.lit(0.05)).alias("lat"),
                    (F.lit(13.15) + (key % 7) * F.lit(0.08)).alias("lon"))
    wh(spark, sf).fixture.table("nation").select(F.to_json(F.collect_list(city))).write.text(path)  # one array, as catalogs are
    register_city_functions(spark, load_city_catalog(spark, path), _bronze(spark, sf)["transport_positions"])
    return spark.sql("SELECT * FROM positions_of_city(:city, :radius)", args={"city": "NATION_2", "radius": 6.0})


# ------------------------------------------------------------ sketches
@register("sketched_reliability", O.with_layers(
    "SELECT route_id, route_mode, count(*) AS observations, count(DISTINCT trip_id) AS trips, count(*) AS sketched, "
    "TRUE AS trips_within, TRUE AS median_within, TRUE AS p95_within FROM fct GROUP BY 1, 2"))
def q_sketched(spark, sf):
    """Distinct trips and delay quantiles merged from stored daily sketches, held against the exact figures: each lies
    within its stated error."""
    import uuid
    from .plans import sketches as S
    from .session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/tramline-sketches-{uuid.uuid4().hex}"
    fact = wh(spark, sf).fct_without_events
    S.store(fact, path)
    e = S.errors(S.merged(spark, path), fact, {"median_delay_seconds": 0.5, "p95_delay_seconds": 0.95})
    return e.select("route_id", "route_mode", "observations", "trips", "sketched",
                    (F.col("trips_error") <= S.DISTINCT_ERROR).alias("trips_within"),
                    (F.col("median_delay_seconds_rank_error") <= S.RANK_ERROR).alias("median_within"),
                    (F.col("p95_delay_seconds_rank_error") <= S.RANK_ERROR).alias("p95_within"))


# --------------------------------------------------------------------- quality
def _quality_frames(spark, sf):
    from .operators import cleaning
    w = wh(spark, sf)
    b = w.bronze
    return {"transport_positions": cleaning.clean("transport_positions", b["transport_positions"], stamp=True),
            "trip_updates": w.silver_trip_updates, "weather_observations": w.silver_weather,
            "city_events": w.silver_events}


def _quality_results(spark, sf):
    from .operators import quality as Q
    frames = _quality_frames(spark, sf)
    out = None
    for table, rules in Q.silver_suites().items():
        r = Q.validate(frames[table], table, rules)
        out = r if out is None else out.unionByName(r)
    return out


def _quality_oracle(summary: bool) -> str:
    from .operators import quality as Q
    suites = Q.silver_suites()
    ok = {("transport_positions", 0): True, ("transport_positions", 7): True}
    src = {"transport_positions": "silver_positions", "trip_updates": "silver_tu",
           "weather_observations": "silver_weather", "city_events": "silver_cev"}
    body = O.quality_sql(src, suites, ok)
    if not summary:
        return O.with_layers(f"SELECT * FROM ({body}) q")
    return O.with_layers(
        f"SELECT table_name, bool_and(success) AS success, CAST(count_if(success) AS BIGINT) AS expectations_passed, "
        f"count(*) AS expectations_total, max(element_count) AS row_count FROM ({body}) q GROUP BY 1")


@register("silver_quality_results", _quality_oracle(False))
def q_quality(spark, sf):
    return _quality_results(spark, sf)


@register("silver_quality_summary", _quality_oracle(True))
def q_quality_summary(spark, sf):
    from .operators import quality as Q
    return Q.summarize(_quality_results(spark, sf)).select(
        "table_name", "success", "expectations_passed", "expectations_total", "row_count")


def _model_oracle() -> str:
    from .operators import quality as Q
    src = {"fct_trip_delays": "fct", "fct_vehicle_positions": "fvp", "mart_route_reliability": "mart_rr",
           "mart_congestion_hotspots": "mart_hot", "mart_delay_trends": "mart_trends"}
    return O.with_layers(f"SELECT * FROM ({O.quality_sql(src, Q.model_tests(), {})}) q")


@register("model_tests", _model_oracle())
def q_model_tests(spark, sf):
    from .operators import quality as Q
    w = wh(spark, sf)
    frames = {"fct_trip_delays": w.fct_trip_delays, "fct_vehicle_positions": w.fct_vehicle_positions,
              "mart_route_reliability": w.mart_route_reliability,
              "mart_congestion_hotspots": w.mart_congestion_hotspots, "mart_delay_trends": w.mart_delay_trends}
    out = None
    for model, rules in Q.model_tests().items():
        r = Q.validate(frames[model], model, rules)
        out = r if out is None else out.unionByName(r)
    return out


def _gtfs_test_oracle() -> str:
    from .operators import quality as Q
    src = {"gtfs_stops": "a_stops", "gtfs_stop_times": "a_stop_times", "gtfs_trips": "a_trips", "gtfs_routes": "a_routes"}
    return O.with_layers(f"SELECT * FROM ({O.quality_sql(src, Q.gtfs_tests(), {})}) q")


@register("gtfs_source_tests", _gtfs_test_oracle())
def q_gtfs_tests(spark, sf):
    from .operators import quality as Q
    out = None
    for table, rules in Q.gtfs_tests().items():
        r = Q.validate(wh(spark, sf).gtfs[table.removeprefix("gtfs_")], table, rules)
        out = r if out is None else out.unionByName(r)
    return out


# ------------------------------------------------------------ scalar functions
@register("position_functions", O.with_layers(O.FUNCS_SQL()))
def q_functions(spark, sf):
    from .functions import buckets as B, geo as G, timefn as T
    p = wh(spark, sf).bronze["transport_positions"]
    d = F.col("delay_seconds")
    lat, lon = F.col("lat"), F.col("lon")
    clat, clon = F.lit(52.52), F.lit(13.405)
    return p.select(
        "vehicle_id", "event_ts",
        round_metric(G.equirect_km(lat, lon, clat, clon), 6).alias("km_from_centre"),
        round_metric(G.sq_deg_dist(lat, lon, clat, clon), 6).alias("sq_deg_from_centre"),
        B.map_delay_class(d).alias("map_class"), B.delay_bucket_code(d).alias("delay_code"),
        B.trip_status(d).alias("status"),
        round_metric(G.congestion_level(F.coalesce(d, F.lit(0.0))), 6).alias("congestion_from_delay"),
        round_metric(G.heading_deg(clat, clon, lat, lon), 6).alias("heading_from_centre"),
        round_metric(T.rush_hour_factor("event_ts"), 6).alias("rush_factor"),
        T.fmt_delay(d).alias("delay_text"), G.weather_zone(lat, lon).alias("weather_zone"),
        G.grid_cell(lat, lon).alias("grid_cell"), T.hour_of_day("event_ts").alias("hour_of_day"),
        T.day_of_week("event_ts").alias("day_of_week"), T.is_rush_hour("event_ts").alias("is_rush_hour"),
        F.to_date("event_ts").alias("service_date"), T.hour_bucket("event_ts").alias("obs_hour"))


@register("event_props", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def q_event_props(spark, sf):
    from .sources.streams import json_field
    ev = wh(spark, sf).fixture.events
    return ev.select("event_id", json_field("props", "$.k", "bigint").alias("k"))


@register("drifting_fields", """
SELECT 'T' || CAST(user_id AS VARCHAR) AS trip_id, ts AS event_ts, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k,
       event_type AS agency_kind, CAST(event_id % 7 AS BIGINT) AS second_tag, event_id % 3 = 0 AS has_extra
FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN props END AS props, CASE WHEN event_id % 3 = 0 THEN event_type END AS event_type),
             event_id AS id FROM events) e
WHERE id % 3 = 0 UNION ALL
SELECT 'T' || CAST(user_id AS VARCHAR), ts, NULL, NULL, NULL, FALSE FROM events WHERE event_id % 3 <> 0""")
def q_drifting_fields(spark, sf):
    """A topic whose producer has added fields to a third of the messages: through the Bronze stream, then read by path."""
    import uuid
    from .session import checkpoint_dir
    from .sources.streams import extra_field
    from .streaming import bronze as B
    root = f"{checkpoint_dir(spark)}/tramline-drift-{uuid.uuid4().hex}"
    e = wh(spark, sf).fixture.events
    known = F.to_json(F.struct(F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("trip_id"),
                               F.col("ts").cast("timestamp").alias("event_ts")), B.JSON_WRITE_OPTIONS)
    added = F.format_string(',"props":%s,"agency":{"kind":"%s","tags":[0,%d]}}', F.col("props"), F.col("event_type"), F.col("event_id") % 7)
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.expr("left(known, length(known) - 1)"), added)).otherwise(F.col("known"))
    e.withColumn("known", known).select(text.alias("value")).write.text(f"{root}/feed/trip_updates")
    B.await_all(spark, [B.start_bronze(spark, "trip_updates", B.Source(path=f"{root}/feed"), root, f"{root}/ckpt", {"availableNow": True})])
    return B.read_extra(spark, root, "trip_updates").select(
        "trip_id", "event_ts", extra_field("$.props.k", "bigint").alias("props_k"), extra_field("$.agency.kind", "string").alias("agency_kind"),
        extra_field("$.agency.tags[1]", "bigint").alias("second_tag"), F.col("extra").isNotNull().alias("has_extra"))


@register("raw_records", O.with_layers(
    "SELECT trip_id, stop_id, delay_seconds, event_ts, TRUE AS stamped FROM a_tu"))
def q_raw_records(spark, sf):
    """Trip updates as raw records (JSON text, event time, ingest stamp), their fields read back from the text."""
    from .sources.streams import json_field, to_raw_records
    raw = to_raw_records(wh(spark, sf).bronze["trip_updates"])
    return raw.select(json_field("record", "$.trip_id").alias("trip_id"), json_field("record", "$.stop_id").alias("stop_id"),
                      json_field("record", "$.delay_seconds", "double").alias("delay_seconds"), "event_ts",
                      F.col("ingested_ts").isNotNull().alias("stamped"))


@register("city_slugs", "SELECT p_partkey, p_name, lower(regexp_replace(regexp_replace(lower(p_name), "
          "'[^a-z0-9]', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM part")
def q_city_slugs(spark, sf):
    """The slug rule (fold accents, non-alphanumerics to '-', trim) over every part name."""
    from .functions.timefn import city_slug
    p = wh(spark, sf).fixture.table("part")
    return p.select("p_partkey", "p_name", city_slug("p_name").alias("slug"))


@register("event_load_factor", O.with_layers(f"""
, pairs AS (SELECT p.vehicle_id, p.event_ts, {O.HAV('p.lat', 'p.lon', 'e.lat', 'e.lon')} AS d, e.impact
            FROM stg_positions p JOIN ev_active e ON e.start_time_utc <= p.event_ts AND e.end_time_utc >= p.event_ts)
SELECT p.vehicle_id, p.event_ts,
       {O.R("1.0::DOUBLE + coalesce(max(CASE WHEN x.d < 3.0 THEN (1.0::DOUBLE - x.d / 3.0::DOUBLE) * coalesce(x.impact, 0.0) ELSE 0.0 END), 0.0)", 6)} AS load_factor
FROM stg_positions p LEFT JOIN pairs x ON x.vehicle_id = p.vehicle_id AND x.event_ts = p.event_ts
GROUP BY 1, 2"""))
def q_event_load(spark, sf):
    from .operators.nearest import event_load_factor
    w = wh(spark, sf)
    return report(event_load_factor(w.stg_positions, w.stg_events, ["vehicle_id", "event_ts"]), ["load_factor"])


# ---------------------------------------------------------------- corrected rows
def _corrected(spark, sf, stream):
    from .sources.fixtures import CORRECTIONS, with_corrections
    return with_corrections(wh(spark, sf).bronze[stream], CORRECTIONS[stream])


def _register_corrected(stream: str, silver: str):
    @register(f"silver_corrected_{stream}", O.with_corrections(stream, f"SELECT * FROM {silver}"))
    def q_corrected(spark, sf):
        from .operators import cleaning
        return cleaning.clean(stream, _corrected(spark, sf, stream), stamp=False)


for _stream, _silver in (("trip_updates", "silver_tu"), ("transport_positions", "silver_positions"), ("city_events", "silver_cev")):
    _register_corrected(_stream, _silver)


# ------------------------------------------------------------------ streaming
def _stream_run(spark, sf, streams):
    from .streaming.runner import StreamRun
    b = wh(spark, sf).bronze
    return StreamRun(spark, {s: b[s] for s in streams})


@register("stream_silver_trip_updates", O.STREAM_SQL["stream_silver_trip_updates"])
def q_stream_silver(spark, sf):
    run = _stream_run(spark, sf, ["trip_updates"])
    out = run.run_append(run.silver("trip_updates"), "silver_tu")
    return out.drop("ingested_ts")


@register("stream_hourly_delay_trend", O.STREAM_SQL["stream_hourly_delay_trend"])
def q_stream_trend(spark, sf):
    from .streaming import continuous as C
    run = _stream_run(spark, sf, ["trip_updates"])
    return run.run_append(C.hourly_delay_trend(run.silver("trip_updates"), watermark=None), "trend")


@register("stream_sliding_hotspots", O.STREAM_SQL["stream_sliding_hotspots"])
def q_stream_hot(spark, sf):
    from .streaming import continuous as C
    run = _stream_run(spark, sf, ["transport_positions"])
    return run.run_append(C.sliding_hotspots(run.silver("transport_positions"), watermark=None), "hotspots")


@register("stream_latest_positions", O.STREAM_SQL["stream_latest_positions"])
def q_stream_latest(spark, sf):
    """State with a time to live, its changelog folded into a snapshot while the stream runs."""
    from .streaming import state as S
    run = _stream_run(spark, sf, ["transport_positions"])
    stream = run.typed("transport_positions")
    changes = S.latest_with_ttl(stream, "vehicle_id", ttl_seconds=6 * 3600)
    out = run.run_into(changes, "latest", lambda p: S.compacting_writer(p, "vehicle_id", every=2))
    return S.read_state(spark, out, "vehicle_id", changes.schema).drop("ingested_ts", "expired")


@register("stream_corrected_updates", O.STREAM_SQL["stream_corrected_updates"])
def q_stream_corrected(spark, sf):
    """A feed in which rows come again, corrected and later: the upserted table gives the batch Silver."""
    from .operators.cleaning import KEYS, apply_rules
    from .streaming import state as S
    from .streaming.runner import StreamRun
    run = StreamRun(spark, {"trip_updates": _corrected(spark, sf, "trip_updates")}, order="ingested_ts")
    out = run.run_into(run.typed("trip_updates"), "upserted", lambda p: S.upsert_writer(p, KEYS["trip_updates"]), "append")
    return apply_rules(spark.read.parquet(out).drop("service_date"), "trip_updates").drop("ingested_ts")


@register("stream_enriched_positions", O.STREAM_SQL["stream_enriched_positions"])
def q_stream_enriched(spark, sf):
    from .session import materialise
    from .streaming import continuous as C
    run = _stream_run(spark, sf, ["transport_positions"])
    weather = materialise(wh(spark, sf).weather_hourly, "weather_hourly")
    return run.run_append(C.enrich_with_weather(run.silver("transport_positions"), weather), "enriched")


@register("stream_capped_updates", O.STREAM_SQL["stream_capped_updates"])
def q_stream_capped(spark, sf):
    from .streaming import continuous as C
    run = _stream_run(spark, sf, ["trip_updates"])
    out = run.run_foreach(run.typed("trip_updates"), "capped", lambda p: C.capped_batch_writer(p, 600),
                          mode="append")
    return out.drop("batch_id", "ingested_ts")


# -------------------------------------------------------------------------- ML
_ML_CACHE: dict = {}


def _models(spark, sf):
    from .plans import ml
    key = (spark.sparkContext.applicationId, id(spark), sf)
    if key not in _ML_CACHE:
        _ML_CACHE.clear()
        _ML_CACHE[key] = ml.train(wh(spark, sf).ml_features)
    return _ML_CACHE[key]


@register("ml_model_metrics", None)
def q_ml_metrics(spark, sf):
    from .plans import ml
    models, test = _models(spark, sf)
    return ml.metrics(models, test)


@register("ml_batch_scores", None)
def q_ml_scores(spark, sf):
    from .plans import ml
    models, _ = _models(spark, sf)
    rows = wh(spark, sf).ml_features  # the whole feature table
    return ml.score(models, rows.select(*ml.CAT_FEATURES, *ml.NUM_FEATURES, "trip_id", "stop_id", "event_ts"))


@register("nearest_active_event_grid", O.with_layers(
    f"SELECT trip_id, stop_id, event_ts, {_r6(['event_proximity_km'])}, nearest_impact, nearest_event_id FROM ei"))
def q_nearest_grid(spark, sf):
    """The same search in rounds of other radii."""
    from .operators.nearest import nearest_active_event
    w = wh(spark, sf)
    pts = w.stg_trip_updates.join(w.dim_stops.select("stop_id", "stop_lat", "stop_lon"), "stop_id")
    return report(nearest_active_event(pts, w.stg_events, ["trip_id", "stop_id", "event_ts"],
                                       radii_km=(0.3, 2.0, 20.0, 16384.0)), ["event_proximity_km"])


@register("fct_trip_delays_grid", O.with_layers(f"SELECT {FACT_COLS}, {_r6(FACT_FLOATS)} FROM fct"))
def q_fct_grid(spark, sf):
    """The flagship fact with other rounds of the event search: one narrow, one that decides the rest."""
    from .plans import facts
    w = wh(spark, sf)
    return report(facts.fct_trip_delays(w.stg_trip_updates, w.stg_events, w.weather_hourly, w.dim_stops, w.dim_trips,
                                        w.dim_routes, w.dim_stop_times, radii_km=(0.5, 16384.0)), FACT_FLOATS)


@register("mart_route_reliability_sorted", O.with_layers("SELECT * FROM mart_rr"))
def q_mart_rr_sorted(spark, sf):
    """Route reliability with histograms of four ranges: many narrow refinements instead of two wide ones."""
    return marts.route_reliability(wh(spark, sf).fct_without_events, ranges=4)


@register("live_active_events", O.with_live("SELECT * FROM le WHERE status = 'ACTIVE'"))
def q_live_active_events(spark, sf):
    from .plans import live
    return live.active_events(_bronze(spark, sf)["city_events"])


@register("quality_last_runs", _quality_oracle(True).replace(", max(element_count) AS row_count FROM", " FROM"))
def q_quality_last_runs(spark, sf):
    """Validate Silver, append the run to a fresh ledger in the shared folder,
    read back the newest 20 runs."""
    import uuid
    from .operators import quality as Q
    from .session import checkpoint_dir
    ledger = f"{checkpoint_dir(spark)}/tramline-ledger-{uuid.uuid4().hex}/quality_runs"
    Q.append_runs(Q.summarize(_quality_results(spark, sf)), ledger)
    return Q.last_runs(spark, ledger, 20).drop("run_at_utc")


# ---------------------------------------------------- pieces of the pipeline, compared on their own
@register("dim_routes", O.with_layers("SELECT * FROM a_routes"))
def q_dim_routes(spark, sf):
    return wh(spark, sf).dim_routes


@register("dim_trips", O.with_layers("SELECT * FROM a_trips"))
def q_dim_trips(spark, sf):
    return wh(spark, sf).dim_trips


@register("dim_stop_times", O.with_layers("SELECT * FROM a_stop_times"))
def q_dim_stop_times(spark, sf):
    return wh(spark, sf).dim_stop_times


@register("gtfs_city_stops_default_radius", O.with_live(O.gtfs_city_sql(25.0) + "SELECT * FROM city_stops"))
def q_city_stops_default(spark, sf):
    from .plans.gtfs_extract import extract_city
    g = wh(spark, sf).gtfs
    return extract_city(g["stops"], g["stop_times"], g["trips"], g["routes"]).require_stops().stops


@register("gtfs_csv_round_trip", O.with_layers("SELECT * EXCLUDE (stop_zone), nullif(stop_zone, '') AS stop_zone FROM a_stops"))
def q_csv_round_trip(spark, sf):
    """Stops exported as sorted CSV, read back by header and typed."""
    import uuid
    from .operators.dims import typed_stops
    from .session import checkpoint_dir
    from .sources.gtfs import GTFS_COLUMNS, export_sorted_csv, read_gtfs_table
    root = f"{checkpoint_dir(spark)}/tramline-csv-{uuid.uuid4().hex}"
    export_sorted_csv(wh(spark, sf).gtfs["stops"], f"{root}/stops.txt", ["stop_id"])
    back = typed_stops(read_gtfs_table(spark, root, "stops", GTFS_COLUMNS["stops"]))
    return back.withColumn("stop_zone", F.nullif("stop_zone", F.lit("")))


def _summary_sql() -> str:
    part = "SELECT '{n}' AS table_name, (SELECT count(*) FROM {a}) AS rows_in, count(*) AS rows_out, " \
           "CAST(count_if(dqr_valid) AS BIGINT) AS rows_valid FROM {s}"
    return " UNION ALL ".join(part.format(n=n, a=a, s=s) for n, a, s in (
        ("transport_positions", "a_pos", "silver_positions"), ("trip_updates", "a_tu", "silver_tu"),
        ("weather_observations", "a_weather", "silver_weather"), ("city_events", "a_cev", "silver_cev")))


@register("silver_row_counts", O.with_layers(_summary_sql()))
def q_silver_counts(spark, sf):
    """Rows in, rows out and valid rows of each Silver table, observed by the pass that computes it."""
    from .operators import cleaning
    rows = []
    for name, bronze in wh(spark, sf).bronze.items():
        silver, seen_in, seen_out = cleaning.silver_with_summary(name, bronze)
        silver.write.format("noop").mode("overwrite").save()
        rows.append((name, seen_in.get["rows_in"], seen_out.get["rows_out"], seen_out.get["rows_valid"]))
    return spark.createDataFrame(rows, "table_name string, rows_in long, rows_out long, rows_valid long")


@register("stream_bronze_counts", O.with_layers(
    "SELECT 'bronze' AS table_name, count(*) AS \"rows\" FROM events WHERE event_id % 100 <> 7 UNION ALL "
    "SELECT 'quarantine', count(*) FROM events WHERE event_id % 100 = 7 UNION ALL "
    "SELECT 'progress', count(*) FROM events"))
def q_bronze_counts(spark, sf):
    """A feed in which some messages are cut short: rows of the Bronze and quarantine tables, and the rows that the
    stream's progress reports."""
    import uuid
    from .session import checkpoint_dir
    from .streaming import bronze as B
    from .streaming.state import ProgressLedger
    root = f"{checkpoint_dir(spark)}/tramline-bronze-{uuid.uuid4().hex}"
    ids = wh(spark, sf).fixture.events.select((F.col("event_id") % 100 == 7).alias("cut"), F.struct(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("trip_id"), F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("value").alias("delay_seconds")).alias("r"))
    text = F.to_json("r", B.JSON_WRITE_OPTIONS)
    ids.select(F.when(F.col("cut"), F.substring(text, 1, 20)).otherwise(text).alias("value")).repartition(8).write.text(
        f"{root}/feed/trip_updates")
    ledger = ProgressLedger(spark, f"{root}/ckpt/counters")
    spark.streams.addListener(ledger)
    try:
        query = B.start_bronze(spark, "trip_updates", B.Source(path=f"{root}/feed", max_files_per_trigger=2), root,
                               f"{root}/ckpt", {"availableNow": True})
        B.await_all(spark, [query])
        seen = ledger.settled(query)["rows"]
    finally:
        spark.streams.removeListener(ledger)
    tables = [read(spark, root, "trip_updates").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(t).alias("table_name"), "rows") for t, read in (("bronze", B.read_bronze), ("quarantine", B.read_quarantine))]
    return tables[0].unionByName(tables[1]).unionByName(
        spark.createDataFrame([("progress", seen)], "table_name string, rows long"))


_PREPARED = """
, prepared AS (
  SELECT trip_id, stop_id, event_ts, delay_seconds,
         CASE WHEN delay_seconds <= 120 THEN 0.0::DOUBLE WHEN delay_seconds <= 600 THEN 1.0 ELSE 2.0 END AS label_class,
         coalesce(route_mode, 'unknown') AS route_mode, coalesce(condition, 'unknown') AS condition,
         CAST(day_of_week AS VARCHAR) AS day_of_week, CAST(hour_of_day AS DOUBLE) AS hour_of_day,
         CAST(is_rush_hour AS DOUBLE) AS is_rush_hour, coalesce(temperature_c, 0.0) AS temperature_c,
         coalesce(precipitation_mm, 0.0) AS precipitation_mm, coalesce(wind_speed_kmh, 0.0) AS wind_speed_kmh,
         CAST(event_nearby AS DOUBLE) AS event_nearby, CAST(stop_zone_num AS DOUBLE) AS stop_zone_num,
         segment_km, event_proximity_km, historical_avg_delay,
         CAST(('0x' || substr(md5('42|' || trip_id || '|' || stop_id || '|' || CAST(epoch_us(event_ts) AS VARCHAR)), 1, 8))
              AS BIGINT) % 10000 >= 8000 AS in_test
  FROM fct WHERE delay_seconds >= -120)
"""
_PREPARED_COLS = ["trip_id", "stop_id", "event_ts", "delay_seconds", "label_class", "route_mode", "condition",
                  "day_of_week", "hour_of_day", "is_rush_hour", "temperature_c", "precipitation_mm", "wind_speed_kmh",
                  "event_nearby", "stop_zone_num"]


@register("ml_prepared_features", O.with_layers(
    _PREPARED + f"SELECT {', '.join(_PREPARED_COLS)}, {_r6(['segment_km', 'event_proximity_km', 'historical_avg_delay'])} "
    "FROM prepared"))
def q_ml_prepared(spark, sf):
    from .plans import ml
    floats = ["segment_km", "event_proximity_km", "historical_avg_delay"]
    return report(ml.prepare(wh(spark, sf).ml_features).select(*_PREPARED_COLS, *floats), floats)


@register("ml_defaulted_features", O.with_layers(
    _PREPARED + "SELECT trip_id, stop_id, event_ts, label_class, 'unknown' AS condition, 0.0::DOUBLE AS wind_speed_kmh, temperature_c FROM prepared"))
def q_ml_defaulted(spark, sf):
    """Feature rows that lack a category and a number."""
    from .plans import ml
    return ml.prepare(wh(spark, sf).ml_features.drop("condition", "wind_speed_kmh")).select(
        "trip_id", "stop_id", "event_ts", "label_class", "condition", "wind_speed_kmh", "temperature_c")


@register("ml_encoded_features", O.with_layers(_PREPARED + f"""
, modes AS (SELECT route_mode, row_number() OVER (ORDER BY count(*) DESC, route_mode) - 1 AS slot FROM prepared GROUP BY 1)
SELECT p.trip_id, p.stop_id, p.event_ts, CAST(m.slot AS INTEGER) AS mode_slot,
       {O.R("(hour_of_day - avg(hour_of_day) OVER ()) / stddev_samp(hour_of_day) OVER ()", 5)} AS hour_scaled,
       {O.R("(temperature_c - avg(temperature_c) OVER ()) / stddev_samp(temperature_c) OVER ()", 5)} AS temperature_scaled
FROM prepared p JOIN modes m ON m.route_mode = p.route_mode"""))
def q_ml_encoded(spark, sf):
    """One-hot slots of the mode and scaled numbers, as the models read them."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from .plans import ml
    from .session import materialise
    data = materialise(ml.prepare(wh(spark, sf).ml_features), "prepared")
    out = Pipeline(stages=ml.feature_stages()).fit(data).transform(data)
    number = {c: i for i, c in enumerate(ml.NUM_FEATURES)}
    scaled, one_hot = vector_to_array("num_scaled"), vector_to_array("route_mode_ohe")
    return out.select("trip_id", "stop_id", "event_ts", (F.array_position(one_hot, F.lit(1.0)) - 1).cast("int").alias("mode_slot"),
                      round_metric(scaled[number["hour_of_day"]], 5).alias("hour_scaled"),
                      round_metric(scaled[number["temperature_c"]], 5).alias("temperature_scaled"))


@register("ml_split_counts", O.with_layers(
    _PREPARED + "SELECT CASE WHEN in_test THEN 'test' ELSE 'train' END AS part, count(*) AS \"rows\", "
    "CAST(sum(label_class) AS BIGINT) AS class_sum FROM prepared GROUP BY 1"))
def q_ml_split(spark, sf):
    from .plans import ml
    from .session import materialise
    rows = ml.prepare(wh(spark, sf).ml_features).select("trip_id", "stop_id", "event_ts", "label_class")
    train, test = ml.split(materialise(rows, "prepared"))  # the fact is built once for both parts
    count = [F.count(F.lit(1)).alias("rows"), F.sum("label_class").cast("long").alias("class_sum")]
    return train.agg(*count).select(F.lit("train").alias("part"), "*").unionByName(
        test.agg(*count).select(F.lit("test").alias("part"), "*"))


@register("ml_metrics_of_average", O.with_layers(_PREPARED + """
, s AS (SELECT delay_seconds AS y, historical_avg_delay AS yhat, CAST(label_class AS INTEGER) AS c,
               CASE WHEN historical_avg_delay <= 120 THEN 0 WHEN historical_avg_delay <= 600 THEN 1 ELSE 2 END AS chat FROM prepared),
k AS (SELECT c AS k FROM s UNION SELECT chat FROM s),
n AS (SELECT k, CASE k WHEN 0 THEN 'on_time' WHEN 1 THEN 'delayed' ELSE 'severe' END AS label,
             (SELECT count(*) FROM s WHERE c = k) AS support, (SELECT count(*) FROM s WHERE chat = k) AS predicted,
             (SELECT count(*) FROM s WHERE c = k AND chat = k) AS tp FROM k),
p AS (SELECT label, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM n)
SELECT 'mae_seconds' AS metric, NULL AS label, round(avg(abs(y - yhat)), 2) AS value FROM s
UNION ALL SELECT 'r2', NULL, round(1 - sum((y - yhat) * (y - yhat)) / (count(*) * var_pop(y)), 4) FROM s
UNION ALL SELECT 'accuracy', NULL, round(avg(CASE WHEN c = chat THEN 1.0::DOUBLE ELSE 0.0 END), 4) FROM s
UNION ALL SELECT 'training_rows', NULL, CAST(count(*) AS DOUBLE) FROM s
UNION ALL SELECT 'test_rows', NULL, CAST(count(*) AS DOUBLE) FROM s
UNION ALL SELECT 'precision', label, round(precision, 4) FROM p UNION ALL SELECT 'recall', label, round(recall, 4) FROM p
UNION ALL SELECT 'f1', label, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 4) FROM p
UNION ALL SELECT 'support', label, CAST(support AS DOUBLE) FROM p"""))
def q_ml_metrics_fixed(spark, sf):
    """The model metrics on a prediction that needs no training: the average delay of the route at the stop."""
    from .functions.buckets import delay_bucket_code
    from .plans import ml
    from .session import materialise
    s = ml.prepare(wh(spark, sf).ml_features).select(
        F.col("delay_seconds").alias("y"), F.col("historical_avg_delay").alias("yhat"),
        F.col("label_class").cast("int").alias("c"), delay_bucket_code("historical_avg_delay").alias("chat"))
    s = materialise(s, "predictions")  # the fact is built once for all metrics
    n = s.count()
    return ml.evaluate(s, n, n)
