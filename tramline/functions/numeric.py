"""Numeric helpers shared by marts (rounding parity across engines)."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_metric(c: Column | str, digits: int = 2) -> Column:
    """Round a metric half-up on its decimal value and return a double.

    The value is first fixed to six decimals so the result does not depend on
    the binary representation of the double (PostgreSQL ``::numeric`` then
    ``ROUND``).
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(18,6)"), digits).cast("double")


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``ROUND(100.0 * num / NULLIF(den, 0), digits)`` computed in double."""
    return round_metric(F.lit(100.0) * numerator.cast("double") / F.nullif(denominator, F.lit(0)), digits)


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))
