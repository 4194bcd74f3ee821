"""Column expressions with the exact rounding and null behaviour of the contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.schemas import MONEY

# Fixed value: mean earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0088


def blank_to_null(column: Column) -> Column:
    """Trim spaces; text that holds nothing else becomes null (tabs are kept)."""
    return F.nullif(F.trim(column), F.lit(""))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Exact signed seconds, to the microsecond, independent of the session time zone."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)")


def _duration(later: Column, earlier: Column, unit_seconds: int) -> Column:
    unit = F.lit(unit_seconds).cast("decimal(6,0)")
    return F.round(seconds_between(later, earlier) / unit, 2).cast(MONEY)


def hours_between(later: Column, earlier: Column) -> Column:
    """Signed hours at two decimals, ties away from zero."""
    return _duration(later, earlier, 3600)


def days_between(later: Column, earlier: Column) -> Column:
    """Signed days at two decimals, ties away from zero."""
    return _duration(later, earlier, 86400)


def day_of_week(timestamp: Column) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(timestamp) - 1


def great_circle_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Great-circle distance in kilometres, null when any coordinate is missing.

    ``least``/``greatest`` skip nulls, so without the guard a missing coordinate
    would come out as half the globe; the clamp keeps ``asin`` inside its domain
    for antipodal points.
    """

    def half_chord(a: Column, b: Column) -> Column:
        half = F.sin(F.radians((a - b) / F.lit(2.0)))
        return half * half

    chord = half_chord(lat_b, lat_a) + F.cos(F.radians(lat_a)) * F.cos(
        F.radians(lat_b)
    ) * half_chord(lng_b, lng_a)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), chord))
    known = lat_a.isNotNull() & lng_a.isNotNull() & lat_b.isNotNull() & lng_b.isNotNull()
    return F.when(known, F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clamped)))


def kilometres(distance: Column) -> Column:
    """A double distance as a two-decimal number, ties away from zero."""
    return F.round(distance.cast("decimal(38,15)"), 2).cast(MONEY)
