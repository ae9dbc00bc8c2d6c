"""Intervals as aligned time slices.

Level 0 slices are 2^SLICE_BITS microseconds long (8.4 s), a slice of the next level holds 2^RADIX_BITS of them. An
interval is the two level-0 slices that its ends lie in, where only a comparison of times decides, and between them the
fewest slices that it covers whole: at most 2 * (2^RADIX_BITS - 1) a level, so their number grows with the logarithm of
its length (and linearly beyond TOP, where a slice lasts 25 days). A moment lies in one slice of each level. So moments
meet the intervals that hold them by an equi-join on (level, slice), and moments of one slice can share what the
intervals that cover it give.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

SLICE_BITS = 23
RADIX_BITS = 3
TOP = 6

_SLICE = "struct<level: int, slice: bigint>"


def _at(micros: Column, level: int) -> Column:
    return F.shiftright(micros, SLICE_BITS + RADIX_BITS * level)


def _micros(c) -> Column:
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def _span(level: int, low: Column, high: Column) -> Column:
    """Slices low, ..., high - 1 of a level."""
    entry = lambda s: F.struct(F.lit(level).alias("level"), s.cast("bigint").alias("slice"))
    return F.when(low < high, F.transform(F.sequence(low, high - 1), entry)).otherwise(F.array().cast(f"array<{_SLICE}>"))


def edge_slices(start, end) -> Column:
    """array<bigint>: the level-0 slices that hold the ends of [start, end]."""
    return F.array_distinct(F.array(_at(_micros(start), 0), _at(_micros(end), 0)))


def covered_slices(start, end) -> Column:
    """array<struct<level, slice>>: the slices that [start, end] covers between the two of its ends."""
    low, high = _at(_micros(start), 0) + 1, _at(_micros(end), 0)  # high is not among them
    whole = 1 << RADIX_BITS
    out = []
    for level in range(TOP + 1):
        shift = RADIX_BITS * level
        lo, hi = F.shiftright(low + ((1 << shift) - 1), shift), F.shiftright(high, shift)
        if level == TOP:
            out.append(_span(level, lo, hi))
            continue
        # what lies between the next level's slices belongs to that level
        left = F.least(hi, F.shiftleft(F.shiftright(lo + (whole - 1), RADIX_BITS), RADIX_BITS))
        right = F.greatest(left, F.shiftleft(F.shiftright(hi, RADIX_BITS), RADIX_BITS))
        out += [_span(level, lo, left), F.when(lo < hi, _span(level, right, hi)).otherwise(F.array().cast(f"array<{_SLICE}>"))]
    return F.concat(*out)


def slices_of(moment) -> Column:
    """array<struct<level, slice>>: the slice of each level that holds a moment."""
    t = _micros(moment)
    return F.array(*[F.struct(F.lit(level).alias("level"), _at(t, level).alias("slice")) for level in range(TOP + 1)])


def edge_slice_of(moment) -> Column:
    return _at(_micros(moment), 0)
