"""Numbers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KNOTS = 1.943844492457398  # fixed value: knots in a metre per second
MISSING = -999.0


def rescaled(value: Column, scale: float, offset: float, low: float, high: float, missing_in: float = MISSING, missing_out: float | None = MISSING) -> Column:
    """M1: value * scale + offset; missing and out-of-range values become ``missing_out``; NaN stays NaN, as no comparison holds for it."""
    out = F.lit(missing_out).cast("double")
    new = value * F.lit(scale) + F.lit(offset)
    return F.when(F.isnan(value), value).when(value == missing_in, out).when((new < low) | (new > high), out).otherwise(new)


def knots(metres_per_second: Column) -> Column:
    return metres_per_second * F.lit(KNOTS)


def lon_signed(lon: Column) -> Column:
    """M4: 0..360 to -180..180."""
    return F.when(lon > 180, (360 - lon) * -1).otherwise(lon)


def lon_positive(lon: Column, center: bool = False) -> Column:
    """M5: -180..180 to 0..360. For a storm's centre 0 becomes 360."""
    return F.when(lon <= 0 if center else lon < 0, lon + 360).otherwise(lon)


def axis(first: Column, last: Column, n: Column) -> Column:
    """M6: n evenly spaced values, both ends included."""
    return F.when(n == 1, F.array(first)).otherwise(F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: first + i * ((last - first) / (n - 1))))


def level_label(pascal: Column) -> Column:
    """M7: hPa with one decimal, from the rounded pascals divided by 100 in whole numbers."""
    return F.format_string("%.1f", F.floor(F.round(pascal).cast("long") / 100).cast("double"))


def checked_latitude(lat: Column) -> Column:
    """an error outside -90..90."""
    return F.when(lat.between(-90, 90), lat).when(lat.isNotNull(), F.raise_error(F.format_string("latitude %s is out of range", lat.cast("string"))).cast("double"))


def checked_longitude(lon: Column) -> Column:
    """made positive; an error outside 0..360."""
    east = lon_positive(lon)
    return F.when(east.between(0, 360), east).when(lon.isNotNull(), F.raise_error(F.format_string("longitude %s is out of range", lon.cast("string"))).cast("double"))


def typed(text: Column, kind: str) -> Column:
    """M8, M9: text as int or float; other kinds are an error."""
    if kind not in ("int", "float"):
        from tidemark.errors import InputError

        raise InputError(f"unknown type {kind}")
    return text.cast("long" if kind == "int" else "double")


def numeric_line(text: Column) -> Column:
    """whether a line begins with an optional sign and a digit."""
    return text.rlike(r"^\s*[-+]?\d")
