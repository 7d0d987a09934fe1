"""Cyclic and calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cyclic(c: str | Column, period: float = 12.0) -> tuple[Column, Column]:
    """(sin, cos) of ``2*pi*c/period``; the constant part folds at plan time."""
    c = F.col(c) if isinstance(c, str) else c
    angle = F.lit(2.0) * F.pi() * c.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def years_since(c: str | Column, current_year: int | None = None) -> Column:
    """``current_year - c``; the year defaults to today's but is a parameter for stable tests."""
    c = F.col(c) if isinstance(c, str) else c
    year = F.lit(current_year) if current_year is not None else F.year(F.current_date())
    return year - c


def epoch_millis(c: str | Column, zone_less: bool = True) -> Column:
    """Milliseconds since the epoch.

    Zone-less timestamps (TIMESTAMP_NTZ) count wall-clock time from 1970-01-01 00:00,
    so the result does not depend on the session time zone; zoned timestamps use the
    instant (``zone_less=False``).
    """
    c = F.col(c) if isinstance(c, str) else c
    if zone_less:
        return F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c)
    return F.unix_millis(c)
