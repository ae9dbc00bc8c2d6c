"""DuckDB SQL for the cross-check: the same adapters, cleaning rules and
models written as plain SQL over the driver's tables.

Every query is ``WITH <layers> SELECT ...``; unused CTEs cost nothing.
"""
from __future__ import annotations


def R(expr: str, d: int = 2) -> str:
    """Half-up rounding on the decimal value, returned as double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(18,6)), {d}) AS DOUBLE)"


def HAV(lat1, lon1, lat2, lon2) -> str:
    return (f"(asin(sqrt(power(sin(radians(({lat2} - {lat1}) / 2.0)), 2) + cos(radians({lat1})) * "
            f"cos(radians({lat2})) * power(sin(radians(({lon2} - {lon1}) / 2.0)), 2))) * 2 * 6371.0)")


def ZONE(lat, lon) -> str:
    return (f"('Z' || CAST(CAST(round(({lat} - 52.52::DOUBLE) / 0.03::DOUBLE) + 2 AS INTEGER) AS VARCHAR) || "
            f"CAST(CAST(round(({lon} - 13.405::DOUBLE) / 0.03::DOUBLE) + 2 AS INTEGER) AS VARCHAR))")


def BUCKET(d) -> str:
    return f"(CASE WHEN {d} <= 120 THEN 'on_time' WHEN {d} <= 600 THEN 'delayed' ELSE 'severe' END)"


def PCT(num: str, den: str = "count(*)") -> str:
    return R(f"100.0::DOUBLE * {num} / nullif({den}, 0)")


def CELL(c) -> str:
    return f"CAST(round(CAST({c} AS DECIMAL(18,6)), 2) AS DECIMAL(9,2))"


def _dedup(src: str, keys: str, order: str) -> str:
    return (f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1")


def _desc(cols: str) -> str:
    return ", ".join(f"{c.strip()} DESC NULLS LAST" for c in cols.split(","))


_DELAY = "CASE WHEN event_id % 50 = 0 THEN NULL ELSE value * 8.0::DOUBLE - 100.0::DOUBLE END"
_MODE = "CASE ({k}) % 3 WHEN 0 THEN 'rail' WHEN 1 THEN 'tram' ELSE 'bus' END"

LAYERS = f"""
a_stops AS (
  SELECT 'S' || CAST(k AS VARCHAR) AS stop_id, stop_name,
         52.442::DOUBLE + CAST(k % 17 AS DOUBLE) * 0.01::DOUBLE AS stop_lat,
         13.302::DOUBLE + CAST(k % 23 AS DOUBLE) * 0.01::DOUBLE AS stop_lon,
         CASE WHEN k % 10 = 0 THEN '' ELSE 'Z' || CAST(1 + k % 5 AS VARCHAR) END AS stop_zone
  FROM (SELECT s_suppkey % 40 AS k, min(s_name) AS stop_name FROM supplier GROUP BY 1) s
),
a_routes AS (
  SELECT 'R' || CAST(n_nationkey AS VARCHAR) AS route_id, 'DE' AS agency_id,
         'L' || CAST(n_nationkey AS VARCHAR) AS route_short_name, n_name AS route_long_name,
         CAST(CASE n_nationkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 3 END AS INTEGER) AS route_type,
         {_MODE.format(k="n_nationkey")} AS route_mode
  FROM nation
),
a_trips AS (
  SELECT DISTINCT 'T' || CAST(user_id AS VARCHAR) AS trip_id, 'R' || CAST(user_id % 25 AS VARCHAR) AS route_id,
         'WD' AS service_id, CAST(user_id % 2 AS INTEGER) AS direction_id,
         'H' || CAST(user_id % 25 AS VARCHAR) AS trip_headsign
  FROM events
),
a_stop_times AS (
  SELECT DISTINCT 'T' || CAST(user_id AS VARCHAR) AS trip_id, 'S' || CAST(event_id % 40 AS VARCHAR) AS stop_id,
         CAST(event_id % 40 AS INTEGER) AS stop_sequence,
         lpad(CAST(5 + (event_id % 40) // 4 AS VARCHAR), 2, '0') || ':' || lpad(CAST((event_id % 40) % 4 * 15 AS VARCHAR), 2, '0') || ':00' AS arrival_time,
         lpad(CAST(5 + (event_id % 40) // 4 AS VARCHAR), 2, '0') || ':' || lpad(CAST((event_id % 40) % 4 * 15 AS VARCHAR), 2, '0') || ':30' AS departure_time
  FROM events
),
a_tu AS (
  SELECT 'T' || CAST(user_id AS VARCHAR) AS trip_id, 'R' || CAST(user_id % 25 AS VARCHAR) AS route_id,
         'V' || CAST(user_id AS VARCHAR) AS vehicle_id, 'S' || CAST(event_id % 40 AS VARCHAR) AS stop_id,
         CAST(event_id % 40 AS INTEGER) AS stop_sequence, ts AS scheduled_arrival_utc,
         make_timestamp(epoch_us(ts) + CAST(round(d * 1000000.0::DOUBLE) AS BIGINT)) AS actual_arrival_utc,
         d AS delay_seconds,
         CASE WHEN d < -60 THEN 'EARLY' WHEN d <= 120 THEN 'ON_TIME' ELSE 'DELAYED' END AS status,
         ts AS event_ts, ts AS ingested_ts
  FROM (SELECT *, {_DELAY} AS d FROM events) e
),
a_pos AS (
  SELECT 'V' || CAST(user_id AS VARCHAR) AS vehicle_id, 'R' || CAST(user_id % 25 AS VARCHAR) AS route_id,
         {_MODE.format(k="user_id % 25")} AS route_mode,
         'T' || CAST(user_id AS VARCHAR) AS trip_id, CAST(user_id % 2 AS INTEGER) AS direction_id,
         'S' || CAST(event_id % 40 AS VARCHAR) AS stop_id, 'S' || CAST((event_id + 1) % 40 AS VARCHAR) AS next_stop_id,
         52.332::DOUBLE + CAST(event_id % 37 AS DOUBLE) * 0.01::DOUBLE AS lat,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE 13.102::DOUBLE + CAST(event_id % 61 AS DOUBLE) * 0.01::DOUBLE END AS lon,
         value - 20.0::DOUBLE AS speed_kmh,
         CAST((event_id * 37) % 360 AS DOUBLE) AS heading_deg,
         {_DELAY} AS delay_seconds,
         CAST(event_id % 100 AS DOUBLE) / 100.0::DOUBLE AS congestion_level,
         ts AS event_ts, ts AS ingested_ts
  FROM events
),
a_weather AS (
  SELECT 'Z' || CAST(event_id % 5 AS VARCHAR) || CAST((event_id % 25) // 5 AS VARCHAR) AS zone_id,
         52.52::DOUBLE + CAST(event_id % 5 - 2 AS DOUBLE) * 0.03::DOUBLE AS lat,
         13.405::DOUBLE + CAST((event_id % 25) // 5 - 2 AS DOUBLE) * 0.03::DOUBLE AS lon,
         value / 5.0::DOUBLE - 10.0::DOUBLE + again AS temperature_c,
         value / 5.0::DOUBLE - 12.0::DOUBLE AS feels_like_c,
         value / 7.0::DOUBLE + 20.0::DOUBLE AS humidity_pct,
         value / 4.0::DOUBLE AS wind_speed_kmh,
         CASE WHEN event_id % 3 = 0 THEN 0.0::DOUBLE ELSE value / 20.0::DOUBLE END AS precipitation_mm,
         CASE event_type WHEN 'click' THEN 'rain' WHEN 'error' THEN 'clear' WHEN 'purchase' THEN 'storm'
                         WHEN 'signup' THEN 'hail' WHEN 'view' THEN 'clouds' END AS condition,
         10.0::DOUBLE AS visibility_km, ts AS event_ts, ts + INTERVAL (again) SECOND AS ingested_ts
  FROM (SELECT *, 0 AS again FROM events UNION ALL SELECT *, 1 FROM events WHERE event_id % 20 = 3) ev
),
a_cev AS (
  SELECT 'EV-' || CAST(event_id AS VARCHAR) AS event_id, 'Event ' || CAST(event_id AS VARCHAR) AS name,
         CASE event_type WHEN 'click' THEN 'concert' WHEN 'error' THEN 'sports' WHEN 'purchase' THEN 'fair'
                         WHEN 'signup' THEN 'demonstration' WHEN 'view' THEN 'festival' END AS category,
         52.482::DOUBLE + CAST(event_id % 13 AS DOUBLE) * 0.007::DOUBLE AS lat,
         13.352::DOUBLE + CAST(event_id % 11 AS DOUBLE) * 0.011::DOUBLE AS lon,
         ts AS start_time_utc, ts + INTERVAL 3 HOUR AS end_time_utc,
         CAST(floor(value * 100.0::DOUBLE) AS BIGINT) AS expected_attendance,
         CAST(event_id % 10 AS DOUBLE) / 10.0::DOUBLE AS impact, 3.0::DOUBLE AS impact_radius_km,
         CASE WHEN event_id % 7 = 0 THEN 'ENDED' ELSE 'ACTIVE' END AS status,
         ts AS event_ts, ts AS ingested_ts
  FROM events
),
silver_positions AS (
  SELECT vehicle_id, route_id, route_mode, trip_id, direction_id, stop_id, next_stop_id, lat, lon, speed_kmh,
         heading_deg, delay_seconds, congestion_level, event_ts, ingested_ts,
         speed_kmh > 140.0 AS dqr_speed_anomaly, delay_seconds > 3600.0 AS dqr_delay_anomaly,
         lat IS NOT NULL AND lon IS NOT NULL AND NOT (speed_kmh > 140.0) AS dqr_valid
  FROM (SELECT * REPLACE (CAST(CASE WHEN speed_kmh < 0 THEN 0.0 ELSE speed_kmh END AS DOUBLE) AS speed_kmh,
                          CAST(coalesce(delay_seconds, 0.0) AS DOUBLE) AS delay_seconds)
        FROM ({_dedup('a_pos', 'vehicle_id, event_ts', 'ingested_ts DESC NULLS LAST, ' + _desc('route_id, route_mode, trip_id, direction_id, stop_id, next_stop_id, lat, lon, speed_kmh, heading_deg, delay_seconds, congestion_level'))}) d
        WHERE lat IS NOT NULL AND lon IS NOT NULL AND lat BETWEEN 52.35 AND 52.68 AND lon BETWEEN 13.08 AND 13.75) x
),
silver_tu AS (
  SELECT *, delay_seconds > 3600.0 AS dqr_delay_anomaly, NOT (delay_seconds > 3600.0) AS dqr_valid
  FROM ({_dedup('a_tu', 'trip_id, stop_id, event_ts', 'ingested_ts DESC NULLS LAST, ' + _desc('route_id, vehicle_id, stop_sequence, scheduled_arrival_utc, actual_arrival_utc, delay_seconds, status'))}) d
  WHERE trip_id IS NOT NULL
),
silver_weather AS (
  SELECT zone_id, lat, lon, temperature_c, feels_like_c, humidity_pct, wind_speed_kmh, precipitation_mm,
         condition, visibility_km, event_ts, ingested_ts,
         temperature_c IS NOT NULL AND condition <> 'unknown' AS dqr_valid
  FROM (SELECT * REPLACE (CASE WHEN condition IN ('clear', 'clouds', 'rain', 'snow', 'fog', 'storm', 'sleet')
                               THEN condition ELSE 'unknown' END AS condition)
        FROM ({_dedup('a_weather', 'zone_id, event_ts', 'ingested_ts DESC NULLS LAST, ' + _desc('lat, lon, temperature_c, feels_like_c, humidity_pct, wind_speed_kmh, precipitation_mm, condition, visibility_km'))}) d) x
),
silver_cev AS (
  SELECT *, lat IS NOT NULL AND lon IS NOT NULL AS dqr_valid
  FROM ({_dedup('a_cev', 'event_id, event_ts', 'ingested_ts DESC NULLS LAST, ' + _desc('name, category, lat, lon, start_time_utc, end_time_utc, expected_attendance, impact, impact_radius_km, status'))}) d
),
stg_positions AS (SELECT * EXCLUDE (dqr_speed_anomaly, dqr_delay_anomaly) FROM silver_positions WHERE dqr_valid),
stg_tu AS (SELECT * EXCLUDE (dqr_delay_anomaly) FROM silver_tu WHERE dqr_valid),
stg_weather AS (SELECT * FROM silver_weather WHERE dqr_valid),
stg_cev AS (SELECT * FROM silver_cev WHERE dqr_valid),
wh AS (
  SELECT zone_id, date_trunc('hour', event_ts) AS obs_hour,
         {R('avg(temperature_c)')} AS temperature_c,
         {R('avg(precipitation_mm)')} AS precipitation_mm,
         {R('max(precipitation_mm)')} AS max_precipitation_mm,
         {R('avg(wind_speed_kmh)')} AS wind_speed_kmh,
         {R('avg(humidity_pct)')} AS humidity_pct,
         (array_agg(condition ORDER BY event_ts DESC))[1] AS condition,
         count(*) AS obs_count
  FROM silver_weather WHERE dqr_valid GROUP BY 1, 2
),
dim_stops AS (
  SELECT stop_id, stop_name, stop_lat, stop_lon, stop_zone,
         CASE WHEN regexp_full_match(stop_zone, 'Z[0-9]+') THEN TRY_CAST(replace(stop_zone, 'Z', '') AS INTEGER) END AS stop_zone_num
  FROM a_stops
),
segments AS (
  SELECT trip_id, stop_id, stop_sequence,
         CASE WHEN prev_lat IS NULL THEN 0.0::DOUBLE ELSE {HAV('prev_lat', 'prev_lon', 'stop_lat', 'stop_lon')} END AS segment_km
  FROM (SELECT st.trip_id, st.stop_id, st.stop_sequence, s.stop_lat, s.stop_lon,
               lag(s.stop_lat) OVER (PARTITION BY st.trip_id ORDER BY st.stop_sequence, st.stop_id) AS prev_lat,
               lag(s.stop_lon) OVER (PARTITION BY st.trip_id ORDER BY st.stop_sequence, st.stop_id) AS prev_lon
        FROM a_stop_times st JOIN dim_stops s USING (stop_id)) x
),
wj AS (
  SELECT tu.trip_id, tu.stop_id, tu.event_ts, w.zone_id AS weather_zone_id, w.temperature_c, w.precipitation_mm,
         w.wind_speed_kmh, w.humidity_pct, w.condition
  FROM stg_tu tu JOIN dim_stops s ON s.stop_id = tu.stop_id
  LEFT JOIN wh w ON w.zone_id = {ZONE('s.stop_lat', 's.stop_lon')} AND w.obs_hour = date_trunc('hour', tu.event_ts)
),
ev_active AS (
  SELECT DISTINCT event_id, lat, lon, start_time_utc, end_time_utc, impact FROM stg_cev
  WHERE status = 'ACTIVE' AND start_time_utc IS NOT NULL AND end_time_utc IS NOT NULL AND start_time_utc <= end_time_utc
),
ev_pairs AS (
  SELECT tu.trip_id, tu.stop_id, tu.event_ts, {HAV('s.stop_lat', 's.stop_lon', 'e.lat', 'e.lon')} AS d,
         e.impact, e.event_id
  FROM stg_tu tu JOIN dim_stops s ON s.stop_id = tu.stop_id
  JOIN ev_active e ON e.start_time_utc <= tu.event_ts AND e.end_time_utc >= tu.event_ts
),
ei AS (
  SELECT trip_id, stop_id, event_ts, d AS event_proximity_km, impact AS nearest_impact, event_id AS nearest_event_id
  FROM ev_pairs
  QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id, event_ts
                             ORDER BY d ASC NULLS LAST, event_id ASC NULLS FIRST, impact ASC NULLS FIRST) = 1
),
rsa AS (SELECT route_id, stop_id, avg(delay_seconds) AS historical_avg_delay FROM stg_tu GROUP BY 1, 2),
fct AS (
  SELECT tu.trip_id, tu.route_id, tu.vehicle_id, tu.stop_id, tu.stop_sequence, tu.delay_seconds,
         {BUCKET('tu.delay_seconds')} AS delay_bucket, tu.status, tu.event_ts,
         CAST(extract(hour FROM tu.event_ts) AS INTEGER) AS hour_of_day,
         CAST(extract(dow FROM tu.event_ts) AS INTEGER) AS day_of_week,
         CASE WHEN extract(hour FROM tu.event_ts) IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour,
         r.route_mode,
         coalesce(seg.segment_km, 0.0::DOUBLE) AS segment_km,
         coalesce(s.stop_zone_num, 0) AS stop_zone_num,
         coalesce(w.weather_zone_id, 'unknown') AS weather_zone_id,
         w.temperature_c, w.precipitation_mm, w.wind_speed_kmh, w.humidity_pct,
         coalesce(w.condition, 'unknown') AS condition,
         coalesce(ei.event_proximity_km, 10.0::DOUBLE) AS event_proximity_km,
         coalesce(ei.nearest_impact, 0.0::DOUBLE) AS nearest_event_impact,
         CASE WHEN ei.event_proximity_km IS NOT NULL THEN 1 ELSE 0 END AS event_nearby,
         coalesce(rsa.historical_avg_delay, 0.0::DOUBLE) AS historical_avg_delay
  FROM stg_tu tu
  LEFT JOIN a_trips t ON t.trip_id = tu.trip_id
  LEFT JOIN a_routes r ON r.route_id = coalesce(t.route_id, tu.route_id)
  LEFT JOIN dim_stops s ON s.stop_id = tu.stop_id
  LEFT JOIN segments seg ON seg.trip_id = tu.trip_id AND seg.stop_id = tu.stop_id
  LEFT JOIN wj w ON w.trip_id = tu.trip_id AND w.stop_id = tu.stop_id AND w.event_ts = tu.event_ts
  LEFT JOIN ei ON ei.trip_id = tu.trip_id AND ei.stop_id = tu.stop_id AND ei.event_ts = tu.event_ts
  LEFT JOIN rsa ON rsa.route_id = tu.route_id AND rsa.stop_id = tu.stop_id
),
fvp AS (
  SELECT tp.vehicle_id, tp.route_id, tp.route_mode, tp.trip_id, tp.stop_id, tp.lat, tp.lon, tp.speed_kmh,
         tp.heading_deg, tp.delay_seconds, {BUCKET('tp.delay_seconds')} AS delay_bucket, tp.congestion_level,
         tp.event_ts, CAST({CELL('tp.lat')} AS VARCHAR) || '|' || CAST({CELL('tp.lon')} AS VARCHAR) AS grid_cell,
         CAST({CELL('tp.lat')} AS DOUBLE) AS cell_lat, CAST({CELL('tp.lon')} AS DOUBLE) AS cell_lon,
         wh.zone_id AS weather_zone_id, wh.condition, wh.precipitation_mm, wh.wind_speed_kmh
  FROM stg_positions tp
  LEFT JOIN wh ON wh.zone_id = {ZONE('tp.lat', 'tp.lon')} AND wh.obs_hour = date_trunc('hour', tp.event_ts)
),
mart_rr AS (
  SELECT route_id, route_mode, CAST(event_ts AS DATE) AS service_date, count(*) AS stops_observed,
         count(DISTINCT trip_id) AS trips,
         {R('avg(delay_seconds)')} AS avg_delay_seconds,
         {R('quantile_cont(delay_seconds, 0.95)')} AS p95_delay_seconds,
         {R('quantile_cont(delay_seconds, 0.5)')} AS median_delay_seconds,
         {R('max(delay_seconds)')} AS max_delay_seconds,
         {PCT("count_if(delay_bucket = 'on_time')")} AS on_time_pct,
         {PCT("count_if(delay_bucket = 'severe')")} AS severe_pct,
         {R("100.0::DOUBLE * (0.7::DOUBLE * count_if(delay_bucket = 'on_time') + 0.2::DOUBLE * count_if(delay_bucket = 'delayed')) / nullif(count(*), 0)")} AS reliability_score
  FROM fct GROUP BY 1, 2, 3
),
mart_trends AS (
  SELECT CAST(event_ts AS DATE) AS service_date, CAST(extract(hour FROM event_ts) AS INTEGER) AS hour_of_day,
         count(*) AS observations, count(DISTINCT trip_id) AS trips,
         {R('avg(delay_seconds)')} AS avg_delay_seconds,
         {R('max(delay_seconds)')} AS max_delay_seconds,
         {PCT("count_if(delay_bucket = 'on_time')")} AS on_time_pct,
         {PCT("count_if(delay_bucket = 'severe')")} AS severe_pct,
         {R('avg(CASE WHEN is_rush_hour = 1 THEN delay_seconds END)')} AS avg_delay_rush_hour
  FROM fct GROUP BY 1, 2
),
mart_hot AS (
  SELECT grid_cell, cell_lat, cell_lon, count(*) AS observations, count(DISTINCT vehicle_id) AS vehicles,
         {R('avg(speed_kmh)')} AS avg_speed_kmh,
         {R('avg(congestion_level)', 3)} AS avg_congestion,
         {R('avg(delay_seconds)')} AS avg_delay_seconds,
         {PCT("count_if(delay_bucket = 'severe')")} AS severe_pct,
         coalesce((array_agg(condition ORDER BY event_ts DESC))[1], 'unknown') AS condition,
         row_number() OVER (ORDER BY {R('avg(delay_seconds)', 6)} DESC, grid_cell) AS congestion_rank
  FROM fvp WHERE event_ts >= (SELECT max(event_ts) FROM fvp) - INTERVAL 24 HOUR
  GROUP BY 1, 2, 3
),
mart_wi AS (
  SELECT condition,
         CASE WHEN precipitation_mm IS NULL THEN 'unknown' WHEN precipitation_mm = 0 THEN 'none'
              WHEN precipitation_mm < 2 THEN 'light' WHEN precipitation_mm < 6 THEN 'moderate' ELSE 'heavy' END AS precip_bucket,
         CASE WHEN temperature_c IS NULL THEN 'unknown' WHEN temperature_c < 0 THEN 'below_zero'
              WHEN temperature_c < 12 THEN 'cold' WHEN temperature_c < 22 THEN 'mild' ELSE 'warm' END AS temp_bucket,
         count(*) AS observations,
         {R('avg(delay_seconds)')} AS avg_delay_seconds,
         {R('quantile_cont(delay_seconds, 0.95)')} AS p95_delay_seconds,
         {PCT("count_if(delay_bucket = 'on_time')")} AS on_time_pct,
         {PCT("count_if(delay_bucket = 'severe')")} AS severe_pct
  FROM fct GROUP BY 1, 2, 3
),
mart_ei AS (
  SELECT CASE WHEN event_proximity_km IS NULL THEN 'no_event' WHEN event_proximity_km < 1.0 THEN 'inside_1km'
              WHEN event_proximity_km < 2.0 THEN 'within_2km' WHEN event_proximity_km < 4.0 THEN 'within_4km'
              ELSE 'far' END AS proximity_bucket,
         count(*) AS observations,
         {R('avg(delay_seconds)')} AS avg_delay_seconds,
         {R('quantile_cont(delay_seconds, 0.95)')} AS p95_delay_seconds,
         {PCT("count_if(delay_bucket = 'on_time')")} AS on_time_pct,
         {R('avg(nearest_event_impact)', 3)} AS avg_event_impact
  FROM fct GROUP BY 1
)
"""


def with_layers(select: str) -> str:
    return "WITH " + LAYERS.strip() + "\n" + select


def NR(col: str, q: float = 0.95) -> str:
    """Nearest-rank percentile over a group."""
    return f"list_sort(list({col}))[CAST(floor({q}::DOUBLE * (count({col}) - 1)) AS BIGINT) + 1]"


_POS_REST = ("route_id, route_mode, trip_id, direction_id, stop_id, next_stop_id, lat, lon, speed_kmh, heading_deg, "
             "delay_seconds, congestion_level, ingested_ts")
_W_REST = ("lat, lon, temperature_c, feels_like_c, humidity_pct, wind_speed_kmh, precipitation_mm, condition, "
           "visibility_km, ingested_ts")
_E_REST = ("name, category, lat, lon, start_time_utc, end_time_utc, expected_attendance, impact, impact_radius_km, "
           "status, ingested_ts")

LIVE = f"""
lp AS (SELECT * FROM a_pos WHERE vehicle_id IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY event_ts DESC NULLS LAST, {_desc(_POS_REST)}) = 1),
lw AS (SELECT * FROM a_weather WHERE zone_id IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY event_ts DESC NULLS LAST, {_desc(_W_REST)}) = 1),
le AS (SELECT * FROM a_cev WHERE event_id IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_ts DESC NULLS LAST, {_desc(_E_REST)}) = 1),
recent AS (SELECT *, coalesce(CAST(delay_seconds AS DOUBLE), 0.0::DOUBLE) AS d FROM a_tu
           ORDER BY event_ts DESC NULLS LAST, trip_id DESC NULLS LAST, stop_id DESC NULLS LAST LIMIT 1500),
rr AS (SELECT r.*, p.lat AS p_lat, p.lon AS p_lon FROM recent r LEFT JOIN lp p ON p.vehicle_id = r.vehicle_id)
"""


def with_live(select: str) -> str:
    select = select.lstrip("\n")
    return "WITH " + LAYERS.strip() + ",\n" + LIVE.strip() + ("" if select.startswith(",") else "\n") + select


def EQKM(lat1, lon1, lat2, lon2) -> str:
    return (f"sqrt((({lat1}) - ({lat2})) * 111.0::DOUBLE * (({lat1}) - ({lat2})) * 111.0::DOUBLE + "
            f"(({lon1}) - ({lon2})) * 111.0::DOUBLE * 0.7::DOUBLE * (({lon1}) - ({lon2})) * 111.0::DOUBLE * 0.7::DOUBLE)")


LIVE_SQL = {
    "live_top_routes": with_live(f"""
SELECT route_id, {R('avg(d)')} AS avg_delay_seconds, {R(NR('d'))} AS p95_delay_seconds, count(*) AS observations,
       {PCT('count_if(d <= 120)')} AS on_time_pct
FROM recent GROUP BY 1 ORDER BY avg_delay_seconds DESC, route_id LIMIT 10"""),
    "live_delay_trends": with_live(f"""
SELECT strftime(event_ts, '%Y-%m-%dT%H:00:00') AS bucket, {R('avg(d)')} AS avg_delay_seconds, count(*) AS observations,
       {PCT('count_if(d <= 120)')} AS on_time_pct
FROM recent WHERE event_ts IS NOT NULL GROUP BY 1 ORDER BY bucket DESC LIMIT 24"""),
    "live_hotspots": with_live(f"""
SELECT CAST({R('lat')} AS VARCHAR) || '|' || CAST({R('lon')} AS VARCHAR) AS grid_cell, {R('lat')} AS lat, {R('lon')} AS lon,
       {R('avg(coalesce(delay_seconds, 0.0))')} AS avg_delay_seconds, {R('avg(coalesce(speed_kmh, 0.0))')} AS avg_speed_kmh,
       {R('avg(coalesce(congestion_level, 0.0))', 3)} AS avg_congestion, count(*) AS vehicles
FROM lp WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1, 2, 3
ORDER BY avg_delay_seconds DESC, grid_cell LIMIT 20"""),
    "live_kpis": with_live(f"""
SELECT count(*) AS vehicles_tracked, coalesce({R('avg(d)')}, 0.0::DOUBLE) AS avg_delay_seconds,
       coalesce({PCT('count_if(d <= 120)')}, 100.0::DOUBLE) AS on_time_pct, CAST(count_if(d > 600) AS BIGINT) AS severe_delays,
       coalesce({R('avg(s)')}, 0.0::DOUBLE) AS avg_speed_kmh,
       (SELECT count(*) FROM le WHERE status = 'ACTIVE') AS active_events
FROM (SELECT coalesce(delay_seconds, 0.0) AS d, coalesce(speed_kmh, 0.0) AS s FROM lp) x"""),
    "live_weather_impact": with_live(f"""
, zones AS (SELECT lat, lon, zone_id, condition FROM lw WHERE lat IS NOT NULL AND lon IS NOT NULL),
nz AS (SELECT rr.trip_id, rr.stop_id, rr.event_ts, z.condition
       FROM rr JOIN zones z ON TRUE WHERE rr.p_lat IS NOT NULL AND rr.p_lon IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY rr.trip_id, rr.stop_id, rr.event_ts
         ORDER BY (rr.p_lat - z.lat) * (rr.p_lat - z.lat) + (rr.p_lon - z.lon) * (rr.p_lon - z.lon),
                  z.zone_id NULLS FIRST, z.condition NULLS FIRST) = 1)
SELECT CASE WHEN rr.p_lat IS NULL OR rr.p_lon IS NULL THEN 'unknown'
            WHEN nz.condition IS NULL OR nz.condition = '' THEN 'unknown' ELSE nz.condition END AS condition,
       {R('avg(d)')} AS avg_delay_seconds, count(*) AS observations, {PCT('count_if(d <= 120)')} AS on_time_pct
FROM rr LEFT JOIN nz ON nz.trip_id = rr.trip_id AND nz.stop_id = rr.stop_id AND nz.event_ts = rr.event_ts
GROUP BY 1""".replace("\n, zones", "\n, zones", 1)),
    "live_route_reliability": with_live(f"""
, modes AS (SELECT route_id, route_mode AS mode FROM lp
            QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY event_ts DESC NULLS LAST, vehicle_id DESC NULLS LAST) = 1),
s AS (SELECT route_id, {R('avg(d)')} AS avg_delay_seconds, {R(NR('d'))} AS p95_delay_seconds,
             {PCT('count_if(d <= 120)')} AS on_time_pct, {PCT('count_if(d > 600)')} AS severe_pct,
             count(*) AS stops_observed FROM recent GROUP BY 1)
SELECT s.*, coalesce(m.mode, 'unknown') AS route_mode FROM s LEFT JOIN modes m ON m.route_id = s.route_id
ORDER BY avg_delay_seconds DESC, s.route_id LIMIT 25"""),
    "live_events_impact": with_live(f"""
, act AS (SELECT lat, lon FROM le WHERE status = 'ACTIVE' AND lat IS NOT NULL AND lon IS NOT NULL),
pairs AS (SELECT rr.d, {EQKM('rr.p_lat', 'rr.p_lon', 'a.lat', 'a.lon')} AS km
          FROM rr JOIN act a ON TRUE WHERE rr.p_lat IS NOT NULL AND rr.p_lon IS NOT NULL),
b AS (SELECT CASE WHEN km <= 2.0 THEN 'within_2km' WHEN km <= 5.0 THEN 'within_5km' ELSE 'far' END AS proximity_bucket, d
      FROM pairs)
SELECT proximity_bucket, count(*) AS observations, {R('avg(d)')} AS avg_delay_seconds,
       {R(NR('d'))} AS p95_delay_seconds, {PCT('count_if(d <= 120)')} AS on_time_pct, 0.0::DOUBLE AS avg_event_impact
FROM b GROUP BY 1"""),
    "live_current_delays": with_live("""
SELECT *, (SELECT count(*) FROM lp) AS vehicle_count FROM (
  SELECT vehicle_id, route_id, route_mode, lat, lon, speed_kmh, delay_seconds, congestion_level, event_ts FROM lp
  ORDER BY coalesce(delay_seconds, 0.0) DESC, vehicle_id LIMIT 200) t"""),
    "live_weather_current": with_live("""
SELECT *, row_number() OVER (ORDER BY event_ts DESC NULLS LAST, zone_id) = 1 AS is_headline FROM lw"""),
    "latest_event_state": with_live("SELECT * FROM le"),
    "ingest_counters": with_live(f"""
SELECT stream, count(*) AS records,
       {R('count(*) / greatest((epoch_us(max(ingested_ts)) - epoch_us(min(ingested_ts))) / 1000000.0, 1.0)')} AS rate_per_s
FROM (SELECT 'transport_positions' AS stream, ingested_ts FROM a_pos UNION ALL
      SELECT 'trip_updates', ingested_ts FROM a_tu UNION ALL
      SELECT 'weather_observations', ingested_ts FROM a_weather UNION ALL
      SELECT 'city_events', ingested_ts FROM a_cev) u GROUP BY 1"""),
}


# ---------------------------------------------------------------- GTFS extraction
def _bbox_sql(lat: float, lon: float, radius_km: float):
    import math
    lat_d = radius_km / 111.0
    lon_d = radius_km / (111.0 * max(math.cos(math.radians(lat)), 0.2))
    return (f"stop_lat BETWEEN {lat - lat_d!r} AND {lat + lat_d!r} "
            f"AND stop_lon BETWEEN {lon - lon_d!r} AND {lon + lon_d!r}")


def gtfs_city_sql(radius_km: float) -> str:
    return f"""
, city_stops AS (SELECT stop_id, stop_name, stop_lat, stop_lon, '' AS stop_zone FROM a_stops
                 WHERE {_bbox_sql(52.52, 13.405, radius_km)}),
city_st AS (SELECT st.trip_id, st.stop_id, st.stop_sequence, st.arrival_time, st.departure_time
            FROM a_stop_times st JOIN city_stops s ON st.stop_id = s.stop_id),
city_trips AS (SELECT trip_id, route_id, service_id, 0 AS direction_id, '' AS trip_headsign FROM a_trips
               WHERE trip_id IN (SELECT DISTINCT trip_id FROM city_st)),
city_routes AS (SELECT r.route_id, r.route_short_name, r.route_long_name,
                       CASE n.route_type WHEN 0 THEN 'tram' WHEN 1 THEN 'rail' WHEN 2 THEN 'rail' WHEN 3 THEN 'bus'
                                         ELSE 'bus' END AS route_mode
                FROM a_routes r LEFT JOIN a_routes n ON n.route_id = r.route_id
                WHERE r.route_id IN (SELECT DISTINCT route_id FROM city_trips))
"""


RT_SQL = """
, rt_feed AS (
  SELECT CAST(event_id AS VARCHAR) AS entity_id, ts AS feed_ts, event_id, user_id, value,
         epoch_us(ts) // 1000000 AS t0,
         CASE WHEN event_id % 13 = 0 THEN 'X' ELSE 'T' END || CAST(user_id AS VARCHAR) AS trip_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'F' || CAST(user_id % 25 AS VARCHAR) END AS feed_route,
         CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '' ELSE 'V' || CAST(user_id AS VARCHAR) END AS veh_id,
         CASE WHEN event_id % 2 = 0 THEN value - 100.0::DOUBLE END AS trip_delay,
         event_id % 4 AS n_su
  FROM (SELECT event_id, user_id, value, ts FROM events UNION ALL
        SELECT event_id, user_id, value + 30.0::DOUBLE, ts + INTERVAL 20 SECOND FROM events WHERE event_id % 5 = 0) ev),
rt_su AS (
  SELECT f.entity_id, f.feed_ts, r.j AS pos, 'S' || CAST((f.event_id + 7 * r.j) % 45 AS VARCHAR) AS stop_id,
         CAST((f.event_id + r.j) % 40 AS INTEGER) AS stop_sequence,
         (f.event_id + r.j) % 5 = 0 AS arr_missing,
         CASE WHEN (f.event_id + r.j) % 3 = 0 THEN NULL ELSE f.value * CAST(r.j + 1 AS DOUBLE) - 150.0::DOUBLE END AS arr_delay,
         f.t0 + 120 * r.j AS arr_time,
         (f.event_id + r.j) % 4 = 1 AS dep_missing,
         f.value - 60.0::DOUBLE * CAST(r.j AS DOUBLE) AS dep_delay,
         CASE WHEN (f.event_id + r.j) % 6 = 0 THEN NULL ELSE f.t0 + 120 * r.j + 30 END AS dep_time
  FROM rt_feed f JOIN range(0, 3) r(j) ON r.j < f.n_su),
rt_city AS (
  SELECT *, CASE WHEN NOT arr_missing AND arr_delay IS NOT NULL THEN arr_delay
                 WHEN NOT dep_missing AND dep_delay IS NOT NULL THEN dep_delay END AS sd,
            CASE WHEN NOT arr_missing AND arr_time IS NOT NULL THEN arr_time
                 WHEN NOT dep_missing AND dep_time IS NOT NULL THEN dep_time END AS et
  FROM rt_su WHERE stop_id IN (SELECT stop_id FROM a_stops)),
rt_best AS (SELECT * FROM rt_city WHERE sd IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY entity_id, feed_ts ORDER BY abs(sd) DESC, pos) = 1),
rt_first AS (SELECT * FROM rt_city QUALIFY row_number() OVER (PARTITION BY entity_id, feed_ts ORDER BY pos) = 1),
rt_rec AS (
  SELECT f.entity_id, f.feed_ts, f.trip_id, f.feed_route, f.veh_id,
         CASE WHEN b.entity_id IS NOT NULL THEN b.stop_id ELSE fi.stop_id END AS stop_id,
         CASE WHEN b.entity_id IS NOT NULL THEN b.stop_sequence ELSE fi.stop_sequence END AS stop_sequence,
         CASE WHEN b.entity_id IS NOT NULL THEN b.et ELSE fi.et END AS et,
         CASE WHEN b.entity_id IS NOT NULL THEN b.sd ELSE f.trip_delay END AS delay
  FROM rt_feed f LEFT JOIN rt_best b ON b.entity_id = f.entity_id AND b.feed_ts = f.feed_ts
  LEFT JOIN rt_first fi ON fi.entity_id = f.entity_id AND fi.feed_ts = f.feed_ts
  WHERE b.entity_id IS NOT NULL OR (f.trip_delay IS NOT NULL AND fi.entity_id IS NOT NULL)),
rt_out AS (
  SELECT r.trip_id, coalesce(t.route_id, r.feed_route, '') AS route_id,
         CASE WHEN r.veh_id IS NOT NULL AND r.veh_id <> '' THEN r.veh_id ELSE 'rt-' || r.entity_id END AS vehicle_id,
         r.stop_id, r.stop_sequence,
         CASE WHEN r.et IS NOT NULL AND r.et <> 0 THEN make_timestamp(CAST(floor(r.et - r.delay) AS BIGINT) * 1000000)
              ELSE make_timestamp(CAST(floor(epoch_us(r.feed_ts) / 1000000.0) AS BIGINT) * 1000000) END AS scheduled_arrival_utc,
         CASE WHEN r.et IS NOT NULL AND r.et <> 0 THEN make_timestamp(r.et * 1000000)
              ELSE make_timestamp(CAST(floor((epoch_us(r.feed_ts) + CAST(round(r.delay * 1000000.0) AS BIGINT)) / 1000000.0) AS BIGINT) * 1000000) END AS actual_arrival_utc,
         CAST(round(CAST(r.delay AS DECIMAL(18,6)), 1) AS DOUBLE) AS delay_seconds,
         CASE WHEN r.delay < -60 THEN 'EARLY' WHEN r.delay <= 120 THEN 'ON_TIME' ELSE 'DELAYED' END AS status,
         r.feed_ts AS event_ts, r.entity_id
  FROM rt_rec r LEFT JOIN a_trips t ON t.trip_id = r.trip_id)
"""


def quality_sql(tables: dict, rules_by_table: dict, schema_ok: dict) -> str:
    """Per-rule counts in SQL for the given {table: cte} mapping."""
    import json as _json
    parts = []
    for table, rules in rules_by_table.items():
        src = tables[table]
        for i, r in enumerate(rules):
            c = r.kwargs.get("column")
            kw = _json.dumps(r.kwargs, sort_keys=True).replace("'", "''")
            col_sql = f"'{c}'" if c else "CAST(NULL AS VARCHAR)"
            if r.type.endswith("not_be_null"):
                bad = f"count_if({c} IS NULL)"
            elif r.type.endswith("be_between"):
                lo, hi = r.kwargs.get("min_value"), r.kwargs.get("max_value")
                conds = ([f"{c} < {lo!r}"] if lo is not None else []) + ([f"{c} > {hi!r}"] if hi is not None else [])
                bad = f"count_if({c} IS NOT NULL AND ({' OR '.join(conds) or 'FALSE'}))"
            elif r.type.endswith("in_set") or r.type == "accepted_values":
                vals = r.kwargs.get("value_set", r.kwargs.get("values"))
                lit = ", ".join(repr(v) if not isinstance(v, str) else "'" + v + "'" for v in vals)
                bad = f"count_if({c} IS NOT NULL AND {c} NOT IN ({lit}))"
            elif r.type == "greater_than_equal_zero":
                bad = f"count_if({c} < 0)"
            else:
                bad = None
            if bad is None:
                ok = "TRUE" if schema_ok[(table, i)] else "FALSE"
                parts.append(f"SELECT '{table}' AS table_name, {i} AS rule_index, '{r.type}' AS expectation_type, "
                             f"{col_sql} AS column_name, '{kw}' AS kwargs, count(*) AS element_count, "
                             f"CAST(NULL AS BIGINT) AS unexpected_count, {ok} AS success FROM {src}")
            else:
                parts.append(f"SELECT '{table}' AS table_name, {i} AS rule_index, '{r.type}' AS expectation_type, "
                             f"{col_sql} AS column_name, '{kw}' AS kwargs, count(*) AS element_count, "
                             f"CAST({bad} AS BIGINT) AS unexpected_count, {bad} = 0 AS success FROM {src}")
    return "\n UNION ALL ".join(parts)


def FUNCS_SQL() -> str:
    d = "p.delay_seconds"
    return f"""
SELECT p.vehicle_id, p.event_ts,
       {R(EQKM('p.lat', 'p.lon', '52.52::DOUBLE', '13.405::DOUBLE'), 6)} AS km_from_centre,
       {R('(p.lat - 52.52::DOUBLE) * (p.lat - 52.52::DOUBLE) + (p.lon - 13.405::DOUBLE) * (p.lon - 13.405::DOUBLE)', 6)} AS sq_deg_from_centre,
       CASE WHEN {d} IS NULL OR {d} <= 30 THEN 'on-time' WHEN {d} <= 120 THEN 'mid' WHEN {d} <= 300 THEN 'late' ELSE 'severe' END AS map_class,
       CASE WHEN {d} <= 120 THEN 0 WHEN {d} <= 600 THEN 1 ELSE 2 END AS delay_code,
       CASE WHEN {d} < -60 THEN 'EARLY' WHEN {d} <= 120 THEN 'ON_TIME' ELSE 'DELAYED' END AS status,
       {R('1.0::DOUBLE / (1.0::DOUBLE + greatest(coalesce(' + d + ', 0.0), 0.0) / 180.0::DOUBLE)', 6)} AS congestion_from_delay,
       {R('((degrees(atan2(p.lon - 13.405::DOUBLE, p.lat - 52.52::DOUBLE)) % 360.0) + 360.0) % 360.0', 6)} AS heading_from_centre,
       {R('1.0::DOUBLE + 0.35::DOUBLE * (exp(-power(CAST(extract(hour FROM p.event_ts) AS DOUBLE) + 1 - 8, 2) / 4.0::DOUBLE) + exp(-power(CAST(extract(hour FROM p.event_ts) AS DOUBLE) + 1 - 18, 2) / 4.0::DOUBLE))', 6)} AS rush_factor,
       CASE WHEN {d} <= 0 THEN 'on time'
            WHEN floor({d} / 60) >= 1 THEN CAST(CAST(floor({d} / 60) AS BIGINT) AS VARCHAR) || 'm ' || CAST(CAST(round(({d} % 60.0 + 60.0) % 60.0) AS BIGINT) AS VARCHAR) || 's'
            ELSE CAST(CAST(round({d}) AS BIGINT) AS VARCHAR) || 's' END AS delay_text,
       {ZONE('p.lat', 'p.lon')} AS weather_zone,
       CASE WHEN p.lat IS NULL OR p.lon IS NULL THEN NULL ELSE CAST({CELL('p.lat')} AS VARCHAR) || '|' || CAST({CELL('p.lon')} AS VARCHAR) END AS grid_cell,
       CAST(extract(hour FROM p.event_ts) AS INTEGER) AS hour_of_day,
       CAST(extract(dow FROM p.event_ts) AS INTEGER) AS day_of_week,
       CASE WHEN extract(hour FROM p.event_ts) IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour,
       CAST(p.event_ts AS DATE) AS service_date, date_trunc('hour', p.event_ts) AS obs_hour
FROM a_pos p"""


#: Fixed values of the corrected rows (sources/fixtures.py): table, expressions.
CORRECTED = {
    "trip_updates": ("a_tu", "delay_seconds + 45.0::DOUBLE * n AS delay_seconds, 'DELAYED' AS status"),
    "transport_positions": ("a_pos", "speed_kmh + 2.0::DOUBLE * n AS speed_kmh, lat + 0.001::DOUBLE * n AS lat"),
    "city_events": ("a_cev", "0.05::DOUBLE * n AS impact, 'ENDED' AS status"),
}


def with_corrections(stream: str, select: str) -> str:
    """The layers over an input some of whose rows come again, corrected and later."""
    name, change = CORRECTED[stream]
    first = LAYERS.strip().replace(f"{name} AS (", f"{name}_first AS (", 1)
    again = f"""{name} AS (
  SELECT * FROM {name}_first UNION ALL
  SELECT * EXCLUDE (n, h) REPLACE ({change}, ingested_ts + to_minutes(90 * n) AS ingested_ts)
  FROM (SELECT f.*, CAST(r.n AS INTEGER) AS n, ('0x' || substr(md5(CAST(epoch_us(event_ts) AS VARCHAR)), 1, 4))::BIGINT % 20 AS h
        FROM {name}_first f JOIN range(1, 5) r(n) ON TRUE) x WHERE h <= 3 AND n <= 4 - h),
"""
    return "WITH " + first.replace("silver_positions AS (", again + "silver_positions AS (", 1) + "\n" + select


STREAM_SQL = {
    "stream_silver_trip_updates": with_layers("SELECT * EXCLUDE (ingested_ts) FROM silver_tu"),
    "stream_hourly_delay_trend": with_layers(f"""
SELECT date_trunc('hour', event_ts) AS window_start, date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS observations, {R('avg(delay_seconds)')} AS avg_delay_seconds,
       {PCT('count_if(delay_seconds <= 120)')} AS on_time_pct
FROM stg_tu GROUP BY 1, 2
HAVING date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM a_tu) - INTERVAL 10 MINUTE"""),
    "stream_sliding_hotspots": with_layers(f"""
, w AS (SELECT date_trunc('hour', event_ts) - INTERVAL (r.k) HOUR AS window_start, delay_seconds, speed_kmh,
              CAST({CELL('lat')} AS VARCHAR) || '|' || CAST({CELL('lon')} AS VARCHAR) AS grid_cell
        FROM stg_positions JOIN range(0, 24) r(k) ON TRUE)
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, grid_cell, count(*) AS observations,
       {R('avg(delay_seconds)')} AS avg_delay_seconds, {R('avg(speed_kmh)')} AS avg_speed_kmh
FROM w GROUP BY 1, 2, 3
HAVING window_start + INTERVAL 24 HOUR <= (SELECT max(event_ts) FROM a_pos) - INTERVAL 10 MINUTE"""),
    "stream_corrected_updates": with_corrections("trip_updates", "SELECT * EXCLUDE (ingested_ts) FROM silver_tu"),
    "stream_latest_positions": with_live("SELECT * EXCLUDE (ingested_ts) FROM lp"),
    "stream_enriched_positions": with_layers("SELECT * FROM fvp"),
    "stream_capped_updates": with_layers("""
SELECT * EXCLUDE (ingested_ts) FROM a_tu, (SELECT min(epoch_us(event_ts)) AS lo, max(epoch_us(event_ts)) AS hi FROM a_tu) m
QUALIFY row_number() OVER (PARTITION BY least(floor((epoch_us(event_ts) - lo) * 4 / greatest(hi - lo, 1)), 3)
  ORDER BY abs(delay_seconds) DESC NULLS LAST, trip_id, stop_id, event_ts) <= 600""".replace(
        "SELECT * EXCLUDE (ingested_ts)", "SELECT * EXCLUDE (ingested_ts, lo, hi)")),
}
