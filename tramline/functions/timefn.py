"""Time and text helpers."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..params import RUSH_HOURS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def day_of_week(ts) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def is_rush_hour(ts) -> Column:
    return F.when(F.hour(_c(ts)).isin(RUSH_HOURS), F.lit(1)).otherwise(F.lit(0))


def hour_bucket(ts) -> Column:
    return F.date_trunc("hour", _c(ts))


def rush_hour_factor(ts, amplitude: float = 1.0, local_offset_hours: int = 1) -> Column:
    """1 + a * 0.35 * (exp(-(h-8)^2/4) + exp(-(h-18)^2/4)) on the event hour."""
    h = F.hour(_c(ts)) + F.lit(local_offset_hours)
    morning = F.exp(-F.pow(h - 8, 2) / 4.0)
    evening = F.exp(-F.pow(h - 18, 2) / 4.0)
    return F.lit(1.0) + F.lit(amplitude * 0.35) * (morning + evening)


def fmt_delay(sec) -> Column:
    """'on time' for <= 0, '3m 5s' from a minute up, else '42s'."""
    s = _c(sec)
    m = F.floor(s / 60)
    return (F.when(s <= 0, F.lit("on time"))
            .when(m >= 1, F.concat(m.cast("string"), F.lit("m "),
                                   F.round(F.pmod(s, F.lit(60.0)), 0).cast("long").cast("string"), F.lit("s")))
            .otherwise(F.concat(F.round(s, 0).cast("long").cast("string"), F.lit("s"))))


# Accent folding for city slugs, built from Unicode decomposition: every Latin-1
# letter whose NFKD form starts with an ASCII letter maps to that letter; other
# non-ASCII letters are dropped (as an ASCII encode with 'ignore' would).
def _fold_tables():
    import unicodedata
    src, dst, drop = [], [], []
    for code in range(0xC0, 0x250):
        ch = chr(code)
        if not ch.isalpha():
            continue
        base = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(base) == 1:
            src.append(ch)
            dst.append(base)
        elif not base:
            drop.append(ch)
    # translate() deletes matched characters that have no replacement
    return "".join(src) + "".join(drop), "".join(dst)


_ACCENTED, _FOLDED = _fold_tables()


def city_slug(name) -> Column:
    """Fold accents, lower-case, non-alphanumerics to '-', trim '-'."""
    s = F.lower(F.translate(_c(name), _ACCENTED, _FOLDED))
    s = F.regexp_replace(s, "[^a-z0-9]", "-")
    return F.regexp_replace(s, "^-+|-+$", "")
