"""Number expressions used in reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def percent(part, whole, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half up; null when ``whole`` is 0."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def tebibytes(total_bytes: Column) -> Column:
    return total_bytes.cast("double") / F.lit(1024.0**4)


def total(column: Column) -> Column:
    """Sum that is 0, not null, over no rows or only nulls."""
    return F.coalesce(F.sum(column), F.lit(0).cast("long"))


def hours_minutes_seconds(seconds) -> Column:
    """Whole seconds as HH:MM:SS; hours are not capped at 24."""
    s = F.floor(F.col(seconds) if isinstance(seconds, str) else seconds).cast("long")
    hours = F.floor(s / 3600).cast("long")
    minutes = F.floor(s % 3600 / 60).cast("long")
    return F.format_string("%02d:%02d:%02d", hours, minutes, s % 60)
