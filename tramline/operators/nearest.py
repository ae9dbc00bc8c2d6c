"""Nearest active event of each point, by aligned time slices and widening cells.

Events are cut into time slices (:mod:`tramline.operators.slices`) and put into square cells of the tangent plane, whose
distances never exceed the great-circle distance. Points are reduced to distinct (place, time) asks. In a round of
radius r a place probes the 2 x 2 cells of side 2r around it, which hold every event within r:

* the slices that events cover whole are answered once for each (place, slice), whatever the number of asks in it, from
  one value for each spot of events in the slice;
* an ask takes the best of its slices' answers, and of the events that begin or end in its own level-0 slice, compared
  by time.

An answer within r is final; the other asks go on to the next, wider round, until none is left. The last round reaches
round the Earth. Everything is an equi-join on (slice, cell), one number each, and a ``min`` over one number, which Spark
combines by hash before the shuffle: neither a list of events nor a sort of the joined pairs is kept anywhere. The sides
of a join that grow with the input are merged, never broadcast: their files are many times smaller than their rows in
memory. The slices of the events are cut once for all rounds, and each round is written to the shared folder, so it is
evaluated once.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import haversine_km
from ..session import materialise
from .joins import EVENT_COLS, tangent_plane_km
from .slices import covered_slices, edge_slice_of, edge_slices, slices_of

#: Radii of the rounds in km; the last one holds the whole tangent plane.
RADII_KM = (1.0, 8.0, 64.0, 16384.0)

_PLACE = ["_lat", "_lon"]
_ASK = [*_PLACE, "_t"]
_SPOT = ["_ev_lat", "_ev_lon"]


def active_intervals(events: DataFrame) -> DataFrame:
    """Active events collapsed to distinct (id, place, interval, impact): re-emitted copies of an event meet nothing
    twice. Events without place or parsed interval can never match and are dropped."""
    return (events.where((F.col("status") == "ACTIVE") & (F.col("start_time_utc") <= F.col("end_time_utc")))
            .select(*EVENT_COLS).distinct()
            .select("event_id", "impact", "start_time_utc", "end_time_utc", F.col("lat").alias("_ev_lat"),
                    F.col("lon").alias("_ev_lon"))
            .where(F.col("_ev_lat").isNotNull() & F.col("_ev_lon").isNotNull()))


def _at() -> Column:
    """Level and slice as one number: what is shuffled most is narrower by it."""
    return F.shiftleft("slice", 3).bitwiseOR(F.col("level").cast("bigint"))


def _cell(u: Column, v: Column) -> Column:
    """A cell as one number. Numbers of cells beyond 32 bits may meet others; their events are then farther ones."""
    return F.shiftleft(u, 32).bitwiseXOR(v)


def _in_cells(df: DataFrame, side: float) -> DataFrame:
    eu, ev = tangent_plane_km(*_SPOT)
    return df.withColumn("_cell", _cell(F.floor(eu / side), F.floor(ev / side)))


def _probes(df: DataFrame, side: float) -> DataFrame:
    """The 2 x 2 cells around a place."""
    pu, pv = tangent_plane_km("_lat", "_lon")
    around = F.array(*[_cell(F.floor(pu / side - 0.5) + i, F.floor(pv / side - 0.5) + j) for i in (0, 1) for j in (0, 1)])
    return df.withColumn("_cell", F.explode(around))


def _distance() -> Column:
    return haversine_km(F.col("_lat"), F.col("_lon"), F.col("_ev_lat"), F.col("_ev_lon"))


def sliced(events: DataFrame, value: Column, best) -> tuple[DataFrame, DataFrame]:
    """(covered, edges) of events: the best value of each spot for each slice that its events cover whole, and each
    event's value at the slices of its ends, with its interval."""
    e = events.select(*_SPOT, "start_time_utc", "end_time_utc", value.alias("_v"))
    covered = e.select(*_SPOT, "_v", F.inline(covered_slices("start_time_utc", "end_time_utc"))) \
        .groupBy("level", "slice", *_SPOT).agg(best("_v").alias("_v"))
    edges = e.withColumn("slice", F.explode(edge_slices("start_time_utc", "end_time_utc")))
    return materialise(covered, "covered"), materialise(edges, "edges")


def around(asks: DataFrame, covered: DataFrame, edges: DataFrame, radius_km: float, value: Column, best) -> DataFrame:
    """asks (_lat, _lon, _t; distinct), covered and edges (sliced) -> asks with ``best``, an aggregate (min, max) of
    ``value`` (over _lat, _lon, the spot's _ev_lat, _ev_lon and its _v) over the events that are active at the ask's time
    and lie within the radius; farther ones in the probed cells may take part as well. Asks without any are left out.
    ``value`` must not get worse where _v gets better, as a spot's best _v stands for its events."""
    side = 2 * radius_km
    slices = asks.select(*_ASK, F.inline(slices_of("_t"))).select(*_ASK, _at().alias("_at"))
    shared = _probes(slices.select(*_PLACE, "_at").distinct(), side).hint("merge").join(
        _in_cells(covered.select(_at().alias("_at"), *_SPOT, "_v"), side).hint("merge"), ["_at", "_cell"]) \
        .groupBy(*_PLACE, "_at").agg(best(value).alias("best"))
    by_slice = slices.hint("merge").join(shared.hint("merge"), [*_PLACE, "_at"]).select(*_ASK, "best")
    by_time = _probes(asks.select(*_ASK, edge_slice_of("_t").alias("slice")), side).hint("merge").join(
        _in_cells(edges, side).hint("merge"), ["slice", "_cell"]).where(
        (F.col("start_time_utc") <= F.col("_t")) & (F.col("_t") <= F.col("end_time_utc"))).select(*_ASK, value.alias("best"))
    return by_slice.unionByName(by_time).groupBy(*_ASK).agg(best("best").alias("best"))


def asks_of(points: DataFrame, lat: str, lon: str, ts: str) -> DataFrame:
    return points.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), F.col(ts).alias("_t")).where(
        F.col("_lat").isNotNull() & F.col("_lon").isNotNull() & F.col("_t").isNotNull()).distinct()


#: Distance and event number as one decimal(38): the distance in units of 2^-60 km, which keeps every digit of a double
#: beyond a few metres, before a number of at most 15 digits. A decimal is combined by hash, a struct by sorting.
_UNITS = float(1 << 60)
_NUMBERS = Decimal(10 ** 15)


def _farness() -> Column:
    """NaN (a distance between antipodes) counts as the farthest."""
    units = F.coalesce(F.nanvl(_distance(), F.lit(None).cast("double")), F.lit(65536.0)) * F.lit(_UNITS)
    return (units.cast("decimal(23,0)") * F.lit(_NUMBERS)).cast("decimal(38,0)") + F.col("_v").cast("decimal(15,0)")


def numbered(events: DataFrame) -> DataFrame:
    """Active intervals with a number ``_n`` that rises with event id and impact."""
    return events.orderBy("event_id", "impact").withColumn("_n", F.monotonically_increasing_id())


def nearest_events(asks: DataFrame, events: DataFrame, radii_km: tuple = RADII_KM) -> DataFrame:
    """Distinct (_lat, _lon, _t) that have an active event -> the same with best (d km, e id, i impact): the nearest
    one, ties to the smaller id."""
    events = materialise(numbered(active_intervals(events)), "events")
    covered, edges = sliced(events, F.col("_n"), F.min)
    open_ = materialise(asks, "asks")
    decided = None
    for r in radii_km:
        found = around(open_, covered, edges, r, _farness(), F.min)
        last = r == radii_km[-1]
        seen = materialise(found if last else open_.hint("merge").join(found.hint("merge"), _ASK, "left"), "nearest")
        # anything at the radius itself or beyond is left to the next round
        within = F.col("best") < F.lit(Decimal(int(r * _UNITS) * int(_NUMBERS)))
        final = seen if last else seen.where(within)
        decided = final if decided is None else decided.unionByName(final)
        open_ = seen.where(F.col("best").isNull() | ~within).select(*_ASK)
        if last or open_.isEmpty():
            break
    nearest = F.struct(_distance().alias("d"), F.col("event_id").alias("e"), F.col("impact").alias("i"))
    number = (F.col("best") % F.lit(_NUMBERS)).cast("bigint")
    return decided.select(*_ASK, number.alias("_n")).hint("merge").join(
        events.select("_n", *_SPOT, "event_id", "impact").hint("merge"), "_n").select(*_ASK, nearest.alias("best"))


def with_nearest_event(points: DataFrame, events: DataFrame, lat: str = "stop_lat", lon: str = "stop_lon",
                       ts: str = "event_ts", radii_km: tuple = RADII_KM) -> DataFrame:
    """points with event_proximity_km, nearest_impact, nearest_event_id (NULL without an active event); ties in
    distance go to the smaller event id."""
    near = nearest_events(asks_of(points, lat, lon, ts), events, radii_km).hint("merge")
    joined = points.join(near, (points[lat] == near["_lat"]) & (points[lon] == near["_lon"]) & (points[ts] == near["_t"]), "left")
    return joined.select(*[points[c] for c in points.columns], F.col("best.d").alias("event_proximity_km"),
                         F.col("best.i").alias("nearest_impact"), F.col("best.e").alias("nearest_event_id"))


def nearest_active_event(points: DataFrame, events: DataFrame, keys: list[str], lat: str = "stop_lat",
                         lon: str = "stop_lon", ts: str = "event_ts", radii_km: tuple = RADII_KM) -> DataFrame:
    """Closest active event of each point that has one: (keys..., event_proximity_km, nearest_impact,
    nearest_event_id)."""
    columns = list(dict.fromkeys([*keys, lat, lon, ts]))
    return with_nearest_event(points.select(*columns), events, lat, lon, ts, radii_km) \
        .where(F.col("nearest_event_id").isNotNull()) \
        .select(*keys, "event_proximity_km", "nearest_impact", "nearest_event_id")


def event_load_factor(points: DataFrame, events: DataFrame, keys: list[str], lat: str = "lat", lon: str = "lon",
                      ts: str = "event_ts", radius_km: float = 3.0) -> DataFrame:
    """1 + the greatest (1 - d / radius) * impact of the active events within the radius, per point; 1.0 without any.
    The same slices and cells as the nearest event, with ``max`` instead of ``min``."""
    from ..functions.geo import event_load_factor as contribution
    covered, edges = sliced(active_intervals(events), F.coalesce("impact", F.lit(0.0)), F.max)
    share = contribution(_distance(), F.lit(radius_km), F.col("_v"))
    peak = around(materialise(asks_of(points, lat, lon, ts), "asks"), covered, edges, radius_km, share, F.max)
    joined = points.select(*keys, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), F.col(ts).alias("_t")).join(
        peak.hint("merge"), _ASK, "left")
    return joined.groupBy(*keys).agg((F.lit(1.0) + F.coalesce(F.max("best"), F.lit(0.0))).alias("load_factor"))
