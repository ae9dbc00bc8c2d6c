"""Bucketing CASE expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..params import EARLY_BELOW_SECONDS, DEFAULT_THRESHOLDS, Thresholds


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def delay_bucket(delay, th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """on_time / delayed / severe; a NULL delay falls to 'severe' (no NULL arm)."""
    d = _c(delay)
    return (F.when(d <= th.on_time, F.lit("on_time"))
            .when(d <= th.severe, F.lit("delayed"))
            .otherwise(F.lit("severe")))


def delay_bucket_code(delay, th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    d = _c(delay)
    return F.when(d <= th.on_time, F.lit(0)).when(d <= th.severe, F.lit(1)).otherwise(F.lit(2))


def map_delay_class(delay) -> Column:
    """Map marker class: NULL or <=30 on-time, <=120 mid, <=300 late, else severe."""
    d = _c(delay)
    return (F.when(d.isNull() | (d <= 30), F.lit("on-time"))
            .when(d <= 120, F.lit("mid"))
            .when(d <= 300, F.lit("late"))
            .otherwise(F.lit("severe")))


def trip_status(delay) -> Column:
    d = _c(delay)
    return (F.when(d < EARLY_BELOW_SECONDS, F.lit("EARLY"))
            .when(d <= DEFAULT_THRESHOLDS.on_time, F.lit("ON_TIME"))
            .otherwise(F.lit("DELAYED")))


def precip_bucket(p) -> Column:
    p = _c(p)
    return (F.when(p.isNull(), F.lit("unknown")).when(p == 0, F.lit("none"))
            .when(p < 2, F.lit("light")).when(p < 6, F.lit("moderate")).otherwise(F.lit("heavy")))


def temp_bucket(t) -> Column:
    t = _c(t)
    return (F.when(t.isNull(), F.lit("unknown")).when(t < 0, F.lit("below_zero"))
            .when(t < 12, F.lit("cold")).when(t < 22, F.lit("mild")).otherwise(F.lit("warm")))


def proximity_bucket(km) -> Column:
    """Mart buckets; 'no_event' only for a NULL distance."""
    k = _c(km)
    return (F.when(k.isNull(), F.lit("no_event")).when(k < 1.0, F.lit("inside_1km"))
            .when(k < 2.0, F.lit("within_2km")).when(k < 4.0, F.lit("within_4km"))
            .otherwise(F.lit("far")))


def live_proximity_bucket(km) -> Column:
    k = _c(km)
    return F.when(k <= 2.0, F.lit("within_2km")).when(k <= 5.0, F.lit("within_5km")).otherwise(F.lit("far"))


def normalize_condition(c, valid) -> Column:
    c = _c(c)
    return F.when(c.isin(list(valid)), c).otherwise(F.lit("unknown"))
