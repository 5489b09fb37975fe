"""Scalar column expressions.

Every function returns a native ``Column`` so that Catalyst can fold it into
whole-stage code generation; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results:
# mean Earth radius in metres of the spherical model used for distances.
EARTH_RADIUS_M = 6371010.0

# A plain decimal number: optional sign, digits with an optional point, optional exponent.
# NaN, Infinity, "1.0d", "1_000" and blanks are rejected, so Silver never holds NaN.
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
COMPACT_TS_PATTERN = r"^[0-9]{12}$"



def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(value: str | int, width: int = 2) -> str:
    """Zero-fill a parameter (``'1'`` -> ``'01'``; ``'2A'`` and ``'971'`` unchanged)."""
    return str(value).zfill(width)


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace (tabs and newlines too, unlike ``trim``)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def pad_zero(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to ``width`` but never truncate a longer value."""
    c = _col(c)
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), "0")


def parse_compact_ts(c: Column | str) -> Column:
    """Lenient ``yyyyMMddHHmm`` parse to a zone-less timestamp built from its fields (no time
    zone involved); a wrong length, a non-digit, hour 24 or 30 February give null."""
    c = _col(c)

    def field(start: int, length: int) -> Column:
        return F.substring(c, start, length).cast("int")

    return F.when(
        c.rlike(COMPACT_TS_PATTERN),
        F.try_make_timestamp_ntz(field(1, 4), field(5, 2), field(7, 2), field(9, 2), field(11, 2), F.lit(0)),
    )


def to_double(c: Column | str) -> Column:
    """Safe cast of a decimal-point string to double; non-numbers become null."""
    c = _col(c)
    return F.when(c.rlike(DECIMAL_PATTERN), c.try_cast("double"))


def to_long(c: Column | str) -> Column:
    """Safe cast of an integer string to bigint; ``'1.0'`` and blanks become null."""
    c = _col(c)
    return F.when(c.rlike(INTEGER_PATTERN), c.try_cast("bigint"))


def decimal_comma(c: Column | str) -> Column:
    """Strip, turn the decimal comma into a point, then safe-cast to double."""
    return to_double(F.replace(strip(c), F.lit(","), F.lit(".")))


def clean_time(c: Column | str) -> Column:
    """``HH:MM`` / ``HMM`` / blank-padded time -> ``HHMM`` (never truncated)."""
    return pad_zero(F.replace(strip(c), F.lit(":"), F.lit("")), 4)


def haversine_m(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance in metres on the sphere; any double input is accepted."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dp = p2 - p1
    dl = F.radians(_col(lon2)) - F.radians(_col(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def unit_vector(lat: Column | str, lon: Column | str) -> tuple[Column, Column, Column]:
    """Point on the unit sphere. Chord length between two of them orders pairs exactly as
    ``haversine_m`` does (distance = 2R·asin(chord/2)), for any double latitude."""
    p, lam = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(p) * F.cos(lam), F.cos(p) * F.sin(lam), F.sin(p)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 of a zone-less timestamp."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), _col(ts))


def hour_index(ts: Column | str) -> Column:
    """Hours since 1970-01-01 (floor) from the calendar fields: no time zone is involved, so
    equal wall-clock hours always share a bucket, for timestamps of any sign."""
    ts = _col(ts)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
    return days.cast("bigint") * 24 + F.hour(ts)


def minute_index(ts: Column | str) -> Column:
    """Minutes since 1970-01-01 (floor), from the calendar fields like ``hour_index``."""
    return hour_index(ts) * 60 + F.minute(_col(ts))


def url_filename(url: Column | str) -> Column:
    """Last path segment of a URL; null when the URL has no file name."""
    path = F.try_parse_url(_col(url), F.lit("PATH"))
    return F.nullif(F.element_at(F.split(path, "/"), -1), F.lit(""))


def null_safe_diff(a: Column | str, b: Column | str) -> Column:
    """``a IS DISTINCT FROM b``: true when exactly one is null or both differ."""
    return ~_col(a).eqNullSafe(_col(b))


def first_non_empty(*cols: Column | str) -> Column:
    """First argument that is neither null nor ``''``; ``''`` when none is."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols], F.lit(""))


def ntz_literal(value: dt.datetime) -> Column:
    """A zone-less timestamp literal from a naive datetime, independent of any time zone
    (``F.lit`` on a datetime goes through the Python process's local zone)."""
    return F.expr(f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'")


def is_finite(c: Column | str) -> Column:
    c = _col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
