"""Coordinates, WKT points, centroids, range checks and geohash as column
expressions. Everything stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxiframe.functions.numbers import parse_float

# --- fixed values: must equal the standard geohash ----------------------------
# Base-32 alphabet of geohash (no a, i, l, o).
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# Digits of Spark's conv(.., 10, 32) in the same positions.
CONV32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# --- end of fixed values ------------------------------------------------------

COORD_DIGITS = 7
# Coordinates as nearly all lines have them: at most COORD_DIGITS decimals, so that there
# is nothing to round, which goes over the decimal text.
PLAIN_COORD = r"^(?:0|-?[1-9][0-9]{0,2}(?:\.[0-9]{1,7})?)\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_coord(col: Column | str) -> Column:
    """``round(float(text), 7)``; failure or null -> 0.0. NaN/inf pass through
    (they are rejected by :func:`is_finite` before any filter)."""
    c = _c(col)
    value = F.when(c.rlike(PLAIN_COORD), c.try_cast("double")).otherwise(F.round(parse_float(c), COORD_DIGITS))
    return F.coalesce(value, F.lit(0.0))


def is_finite(col: Column | str) -> Column:
    c = _c(col)
    return ~(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))


def finite_coord(col: Column | str) -> Column:
    """``round(float(text), 7)``; null on failure, null, nan and infinity."""
    c = _c(col)
    value = F.round(parse_float(c), COORD_DIGITS)
    return F.when(c.rlike(PLAIN_COORD), c.try_cast("double")).otherwise(F.when(is_finite(value), value))


def coord_text(col: Column | str) -> Column:
    """Canonical text of a coordinate: 7 decimals, trailing zeros trimmed but one
    digit kept after the dot (-73.7000000 -> -73.7, -86 -> -86.0, 0 -> 0.0)."""
    value = _c(col).try_cast("double")
    short, size = value.cast("string"), F.abs(value)
    t = _c(col).try_cast("decimal(10,7)").cast("string")
    trimmed = F.regexp_replace(F.regexp_replace(t, r"0+$", ""), r"\.$", ".0")
    # The text of a double with at most 7 decimals is this text already where it has
    # no exponent; a decimal takes some ten times as long.
    plain = (F.length(short) - F.instr(short, ".") <= COORD_DIGITS) & (size >= 0.001) & (size < 1000)
    return F.when(plain, short).otherwise(trimmed)


def wkt_point(lon: Column | str, lat: Column | str) -> Column:
    """``POINT(lon lat)`` text."""
    return F.concat(F.lit("POINT("), coord_text(lon), F.lit(" "), coord_text(lat), F.lit(")"))


def midpoint(a: Column | str, b: Column | str) -> Column:
    return (_c(a) + _c(b)) / 2


def in_range(lon: Column | str, lat: Column | str) -> Column:
    """EPSG:4326 bounds: lon in [-180, 180], lat in [-90, 90]."""
    return _c(lon).between(-180.0, 180.0) & _c(lat).between(-90.0, 90.0)


def _spread(v: Column) -> Column:
    """Insert a zero bit between the bits of a value below 2^32 (Morton spread)."""
    masks = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF),
             (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
             (1, 0x5555555555555555)]
    for shift, mask in masks:
        v = F.shiftleft(v, shift).bitwiseOR(v).bitwiseAND(F.lit(mask))
    return v


def geohash(lon: Column | str, lat: Column | str, precision: int = 7) -> Column:
    """Standard geohash of a point, null outside the EPSG:4326 bounds.

    The cell index along each axis is ``floor((x - min) / span * 2^bits)``
    (upper edge clamped), the two indices are bit-interleaved with longitude
    first, and the code is written in base 32. Precision 1..12.
    """
    if not 1 <= precision <= 12:
        raise ValueError("geohash precision must be in 1..12")
    lon, lat = _c(lon), _c(lat)
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    x = F.least(F.floor((lon + 180.0) / 360.0 * float(1 << lon_bits)),
                F.lit((1 << lon_bits) - 1)).cast("bigint")
    y = F.least(F.floor((lat + 90.0) / 180.0 * float(1 << lat_bits)),
                F.lit((1 << lat_bits) - 1)).cast("bigint")
    # Longitude owns the most significant interleaved bit.
    if nbits % 2:
        code = _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))
    else:
        code = F.shiftleft(_spread(x), 1).bitwiseOR(_spread(y))
    digits = F.lpad(F.conv(code.cast("string"), 10, 32), precision, "0")
    return F.when(in_range(lon, lat), F.translate(digits, CONV32_DIGITS, GEOHASH_ALPHABET))
