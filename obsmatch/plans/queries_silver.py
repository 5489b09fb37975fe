"""Registered queries: Silver jobs and the scalar cleaning functions (JOB-1/2, FN-*, AGG-4/8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.functions import expr as X
from obsmatch.plans import oracle as O
from obsmatch.plans import silver
from obsmatch.plans.registry import register, sub, with_sql

# Parameters of the registered runs.
DEPARTMENT = "01"
YEAR = 2024
PARIS = (48.8566, 2.3522)
NOON = dt.datetime(2024, 1, 15, 12, 0, 0)


def d_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def d_pad(x: str, n: int) -> str:
    return f"lpad({x}, cast(greatest(length({x}), {n}) AS INTEGER), '0')"


def d_ts(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^[0-9]{{12}}$') THEN try_strptime({x}, '%Y%m%d%H%M') END)"


def d_double(x: str) -> str:
    return rf"(CASE WHEN regexp_matches({x}, '^(\+|-)?([0-9]+|[0-9]+\.[0-9]*|\.[0-9]+)([eE](\+|-)?[0-9]+)?$') THEN TRY_CAST({x} AS DOUBLE) END)"


def d_long(x: str) -> str:
    return rf"(CASE WHEN regexp_matches({x}, '^(\+|-)?[0-9]+$') THEN TRY_CAST({x} AS BIGINT) END)"


def d_clean_time(x: str) -> str:
    return d_pad(f"replace({d_strip(x)}, ':', '')", 4)


def d_comma(x: str) -> str:
    return d_double(f"replace({d_strip(x)}, ',', '.')")


D_ACC_TS = d_ts(f"an || {d_pad('mois', 2)} || {d_pad('jour', 2)} || {d_clean_time('hrmn')}")
D_OBS_TS = d_ts("AAAAMMJJHH || '00'")

SILVER_ACCIDENTS_SQL = f"""SELECT Num_Acc AS accident_id, {D_ACC_TS} AS accident_timestamp, dep AS department,
       com AS city, {d_comma('lat')} AS latitude, {d_comma('"long"')} AS longitude,
       {d_long('atm')} AS atmospheric_condition, {d_long('lum')} AS luminosity, {d_long('col')} AS collision_type
FROM A_RAW WHERE dep = '{DEPARTMENT}'"""

SILVER_WEATHER_SQL = f"""SELECT NUM_POSTE AS station_id, NOM_USUEL AS station_name, '{DEPARTMENT}' AS department,
       ts AS observation_timestamp, {d_double('LAT')} AS latitude, {d_double('LON')} AS longitude,
       {d_double('T')} AS temperature, {d_double('RR1')} AS rainfall_1h, {d_double('FF')} AS wind_speed,
       {d_double('DD')} AS wind_direction
FROM (SELECT *, {D_OBS_TS} AS ts FROM W_RAW) r WHERE year(ts) = {YEAR}"""


@register("silver_accidents", with_sql(("A_RAW",)) + SILVER_ACCIDENTS_SQL)
def silver_accidents(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-1 for department 01."""
    (raw,) = sub(spark, sf, "A_RAW")
    return silver.accidents(raw, DEPARTMENT)


@register("silver_weather", with_sql(("W_RAW",)) + SILVER_WEATHER_SQL)
def silver_weather(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-2 for 2024, department 01."""
    (raw,) = sub(spark, sf, "W_RAW")
    return silver.weather(raw, YEAR, DEPARTMENT)


@register(
    "silver_weather_rejects",
    with_sql(("W_RAW",))
    + f"""SELECT count(*) AS bronze_rows, cast(count_if(ts IS NULL) AS bigint) AS invalid_timestamps,
       cast(count_if(ts IS NOT NULL AND year(ts) <> {YEAR}) AS bigint) AS other_year_rows,
       cast(count_if(year(ts) = {YEAR}) AS bigint) AS silver_rows
FROM (SELECT {D_OBS_TS} AS ts FROM W_RAW) r""",
)
def silver_weather_rejects(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "W_RAW")
    return silver.weather_rejects(raw, YEAR)


@register(
    "stage_row_counts",
    with_sql(("A_RAW", "W_RAW"))
    + f"""SELECT 'accidents' AS dataset, count(*) AS bronze_rows, cast(count_if(dep = '{DEPARTMENT}') AS bigint) AS silver_rows FROM A_RAW
UNION ALL
SELECT 'weather', count(*), cast(count_if(year({D_OBS_TS}) = {YEAR}) AS bigint) FROM W_RAW""",
)
def stage_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw_a, raw_w = sub(spark, sf, "A_RAW", "W_RAW")
    return silver.stage_counts(raw_a, raw_w, DEPARTMENT, YEAR)


@register(
    "fn_clean_time",
    with_sql(("A_RAW",)) + f"SELECT Num_Acc, hrmn, {d_clean_time('hrmn')} AS clean_time FROM A_RAW",
)
def fn_clean_time(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "A_RAW")
    return raw.select("Num_Acc", "hrmn", X.clean_time("hrmn").alias("clean_time"))


@register(
    "fn_parse_timestamp",
    with_sql(("A_RAW", "W_RAW"))
    + f"SELECT 'A' AS src, Num_Acc AS id, {D_ACC_TS} AS ts FROM A_RAW UNION ALL SELECT 'W', AAAAMMJJHH, {D_OBS_TS} FROM W_RAW",
)
def fn_parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    raw_a, raw_w = sub(spark, sf, "A_RAW", "W_RAW")
    a = raw_a.select(F.lit("A").alias("src"), F.col("Num_Acc").alias("id"), silver.accident_timestamp().alias("ts"))
    w = raw_w.select(F.lit("W").alias("src"), F.col("AAAAMMJJHH").alias("id"), silver.observation_timestamp().alias("ts"))
    return a.unionByName(w)


@register(
    "fn_decimal_comma",
    with_sql(("A_RAW",))
    + f"""SELECT Num_Acc, lat, {d_comma('lat')} AS latitude, "long", {d_comma('"long"')} AS longitude FROM A_RAW""",
)
def fn_decimal_comma(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "A_RAW")
    return raw.select(
        "Num_Acc", "lat", X.decimal_comma("lat").alias("latitude"), "long", X.decimal_comma("long").alias("longitude")
    )


@register(
    "fn_safe_int",
    with_sql(("A_RAW",))
    + f"""SELECT Num_Acc, atm, {d_long('atm')} AS atmospheric_condition, {d_long('lum')} AS luminosity,
       col, {d_long('col')} AS collision_type FROM A_RAW""",
)
def fn_safe_int(spark: SparkSession, sf: str) -> DataFrame:
    (raw,) = sub(spark, sf, "A_RAW")
    return raw.select(
        "Num_Acc", "atm", X.to_long("atm").alias("atmospheric_condition"), X.to_long("lum").alias("luminosity"),
        "col", X.to_long("col").alias("collision_type"),
    )


@register(
    "fn_haversine",
    with_sql(("A",))
    + f"""SELECT accident_id, {O.spark_round(O.haversine('latitude', 'longitude', str(PARIS[0]), str(PARIS[1])), 3)} AS distance_m
FROM A WHERE latitude IS NOT NULL""",
)
def fn_haversine(spark: SparkSession, sf: str) -> DataFrame:
    """Great-circle distance of every located accident to a fixed point."""
    (a,) = sub(spark, sf, "A")
    d = X.haversine_m("latitude", "longitude", F.lit(PARIS[0]), F.lit(PARIS[1]))
    return a.where(F.col("latitude").isNotNull()).select("accident_id", F.round(d, 3).alias("distance_m"))


@register(
    "fn_minutes_between",
    with_sql(("W",))
    + f"""SELECT station_id, observation_timestamp,
       date_sub('minute', TIMESTAMP '{NOON:%Y-%m-%d %H:%M:%S}', observation_timestamp) AS minutes_from_noon,
       date_sub('minute', observation_timestamp, TIMESTAMP '{NOON:%Y-%m-%d %H:%M:%S}') AS minutes_to_noon
FROM W""",
)
def fn_minutes_between(spark: SparkSession, sf: str) -> DataFrame:
    """Whole minutes, truncated toward zero, in both directions (seconds are present)."""
    (w,) = sub(spark, sf, "W")
    noon = X.ntz_literal(NOON)
    return w.select(
        "station_id", "observation_timestamp",
        X.minutes_between(noon, "observation_timestamp").alias("minutes_from_noon"),
        X.minutes_between("observation_timestamp", noon).alias("minutes_to_noon"),
    )
