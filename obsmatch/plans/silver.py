"""Silver jobs (JOB-1, JOB-2): raw delimited rows -> typed, cleaned tables.

The reference runs one (year, department) per job. Here the department and year filters take
lists (or nothing, for all), and the weather department can come from a ``department``
partition column of the raw layout instead of a constant, so one run covers many of both.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmatch.functions.expr import (
    clean_time,
    decimal_comma,
    pad_zero,
    parse_compact_ts,
    to_double,
    to_long,
    zfill,
)
from obsmatch.schemas import ACCIDENT_CONTRACT, WEATHER_CONTRACT


def _as_list(v: str | int | Iterable[str | int] | None) -> list | None:
    if v is None:
        return None
    if isinstance(v, (str, int)):
        return [v]
    return list(v)


def accident_timestamp() -> Column:
    """``an`` + ``mois`` + ``jour`` (zero-padded) + cleaned ``hrmn``, leniently parsed."""
    return parse_compact_ts(
        F.concat(F.col("an"), pad_zero("mois", 2), pad_zero("jour", 2), clean_time("hrmn"))
    )


def department_filter(departments: str | int | Iterable[str | int] | None) -> Column:
    deps = _as_list(departments)
    if deps is None:
        return F.lit(True)
    return F.col("dep").isin([zfill(d) for d in deps])


def accidents(raw: DataFrame, departments: str | int | Iterable[str | int] | None = None) -> DataFrame:
    """JOB-1 transform: department filter, then the nine Silver accident columns.

    ``raw`` holds the raw columns as strings. Rows are never filtered by year and null
    timestamps are kept (SURVEY Q5).
    """
    ACCIDENT_CONTRACT.enforce(raw)
    return raw.where(department_filter(departments)).select(
        F.col("Num_Acc").alias("accident_id"),
        accident_timestamp().alias("accident_timestamp"),
        F.col("dep").alias("department"),
        F.col("com").alias("city"),
        decimal_comma("lat").alias("latitude"),
        decimal_comma("long").alias("longitude"),
        to_long("atm").alias("atmospheric_condition"),
        to_long("lum").alias("luminosity"),
        to_long("col").alias("collision_type"),
    )


def observation_timestamp() -> Column:
    return parse_compact_ts(F.concat(F.col("AAAAMMJJHH"), F.lit("00")))


def year_filter(ts: Column, years: str | int | Iterable[str | int] | None) -> Column:
    ys = _as_list(years)
    if ys is None:
        return ts.isNotNull()
    return F.year(ts).isin([int(y) for y in ys])


def weather(
    raw: DataFrame,
    years: str | int | Iterable[str | int] | None = None,
    department: str | None = None,
) -> DataFrame:
    """JOB-2 transform: parse the hour, keep the requested years, ten Silver weather columns.

    ``department`` is a constant (as in the reference); when it is None the raw ``department``
    column -- the partition value of the file's folder -- is used.
    """
    WEATHER_CONTRACT.enforce(raw)
    ts = observation_timestamp()
    dep = F.lit(zfill(department)) if department is not None else F.col("department")
    return (
        raw.withColumn("_ts", ts)
        .where(year_filter(F.col("_ts"), years))
        .select(
            F.col("NUM_POSTE").alias("station_id"),
            F.col("NOM_USUEL").alias("station_name"),
            dep.alias("department"),
            F.col("_ts").alias("observation_timestamp"),
            to_double("LAT").alias("latitude"),
            to_double("LON").alias("longitude"),
            to_double("T").alias("temperature"),
            to_double("RR1").alias("rainfall_1h"),
            to_double("FF").alias("wind_speed"),
            to_double("DD").alias("wind_direction"),
        )
    )


def weather_rejects(raw: DataFrame, years: str | int | Iterable[str | int] | None = None) -> DataFrame:
    """AGG-4 done before the year filter (the reference counts after it and always prints 0):
    one row with the raw rows, the unparseable hours, the rows of other years and the kept rows."""
    WEATHER_CONTRACT.enforce(raw)
    ts = observation_timestamp()
    keep = year_filter(ts, years)
    return raw.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(ts.isNull()).alias("invalid_timestamps"),
        F.count_if(ts.isNotNull() & ~keep).alias("other_year_rows"),
        F.count_if(keep).alias("silver_rows"),
    )


def stage_counts(
    raw_accidents: DataFrame,
    raw_weather: DataFrame,
    departments: str | int | Iterable[str | int] | None,
    years: str | int | Iterable[str | int] | None,
) -> DataFrame:
    """AGG-8: rows before and after each Silver job, one pass per raw table."""
    a = raw_accidents.agg(
        F.count(F.lit(1)).alias("bronze"), F.count_if(department_filter(departments)).alias("silver")
    ).select(F.lit("accidents").alias("dataset"), "bronze", "silver")
    w = raw_weather.agg(
        F.count(F.lit(1)).alias("bronze"), F.count_if(year_filter(observation_timestamp(), years)).alias("silver")
    ).select(F.lit("weather").alias("dataset"), "bronze", "silver")
    return a.unionByName(w).select(
        "dataset", F.col("bronze").alias("bronze_rows"), F.col("silver").alias("silver_rows")
    )
