"""Scalar column functions."""

from obsmatch.functions.expr import (  # noqa: F401
    EARTH_RADIUS_M,
    clean_time,
    decimal_comma,
    first_non_empty,
    haversine_m,
    hour_index,
    is_finite,
    minutes_between,
    null_safe_diff,
    pad_zero,
    parse_compact_ts,
    strip,
    to_double,
    to_long,
    unit_vector,
    url_filename,
    zfill,
)
