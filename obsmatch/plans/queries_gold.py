"""Registered queries: stations, nearest station, time-range join, as-of join, Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.functions.expr import micros
from obsmatch.operators.asof import nearest_in_time, time_range_left_join
from obsmatch.plans import gold, queries_merge
from obsmatch.plans import oracle as O
from obsmatch.plans.jobs import load_and_build_gold
from obsmatch.plans.registry import register, sub, with_sql
from obsmatch.schemas import WEATHER_VALUES
from obsmatch.session import scratch_path
from obsmatch.sources.sinks import VersionedTable

_DIST = O.spark_round("distance_to_station_m", 3)


@register(
    "stations_distinct",
    with_sql(("W",), O.STATIONS) + "SELECT * FROM stations",
)
def stations_distinct(spark: SparkSession, sf: str) -> DataFrame:
    (w,) = sub(spark, sf, "W")
    return gold.stations(w)


@register(
    "nearest_station",
    with_sql(("A", "W"), O.STATIONS, O.NEAREST)
    + f"SELECT accident_id, station_id, station_name, {_DIST} AS distance_to_station_m FROM ns",
)
def nearest_station(spark: SparkSession, sf: str) -> DataFrame:
    a, w = sub(spark, sf, "A", "W")
    n = gold.nearest_station(a, gold.stations(w))
    return n.select(
        "accident_id", "station_id", "station_name", F.round("distance_to_station_m", 3).alias("distance_to_station_m")
    )


@register(
    "nearest_station_dup",
    with_sql(("A_DUP", "W"), O.STATIONS, O.NEAREST.replace("FROM A a", "FROM A_DUP a"))
    + f"SELECT accident_id, station_id, station_name, {_DIST} AS distance_to_station_m, luminosity FROM ns",
)
def nearest_station_dup(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-1: one row per accident id where ids are repeated and null."""
    a, w = sub(spark, sf, "A_DUP", "W")
    n = gold.nearest_station(a, gold.stations(w))
    return n.select("accident_id", "station_id", "station_name", F.round("distance_to_station_m", 3).alias("distance_to_station_m"), "luminosity")


def _candidates_sql(accidents: str) -> str:
    return (
        with_sql((accidents, "W"), O.STATIONS, O.NEAREST.replace("FROM A a", f"FROM {accidents} a"))
        + """SELECT n.accident_id, n.station_id, w.observation_timestamp AS weather_timestamp,
       date_sub('minute', n.accident_timestamp, w.observation_timestamp) AS minutes_from_accident, w.temperature
FROM ns n LEFT JOIN W w ON w.station_id = n.station_id
 AND w.observation_timestamp BETWEEN n.accident_timestamp - INTERVAL 2 HOUR AND n.accident_timestamp + INTERVAL 2 HOUR"""
    )


def _candidates(a: DataFrame, w: DataFrame) -> DataFrame:
    # Times as numbers are made once per row; whole minutes of their difference are then cheap for every pair.
    n = gold.nearest_station(a, gold.stations(w)).select("accident_id", "station_id", "accident_timestamp", micros("accident_timestamp").alias("_a_us"))
    obs = w.select("station_id", F.col("observation_timestamp").alias("weather_timestamp"), "temperature", micros("observation_timestamp").alias("_w_us"))
    pairs = time_range_left_join(
        n, obs, by="station_id", left_ts="accident_timestamp", right_ts="weather_timestamp", tolerance_minutes=120,
    )
    return pairs.select(
        "accident_id", "station_id", "weather_timestamp",
        F.expr("(_w_us - _a_us) div 60000000").alias("minutes_from_accident"),
        "temperature",
    )


@register("weather_candidates", _candidates_sql("A"))
def weather_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """JN-3: left range join of each accident's station to its observations within ±2 h."""
    return _candidates(*sub(spark, sf, "A", "W"))


@register("weather_candidates_dup", _candidates_sql("A_DUP"))
def weather_candidates_dup(spark: SparkSession, sf: str) -> DataFrame:
    """JN-3 over accidents with repeated and null ids."""
    return _candidates(*sub(spark, sf, "A_DUP", "W"))


@register(
    "range_join_rows",
    with_sql(("A_DUP", "W"))
    + """SELECT a.accident_id, a.luminosity, a.station_id, a.accident_timestamp, w.observation_timestamp AS weather_timestamp
FROM (SELECT *, cast(luminosity * 7 AS varchar) AS station_id FROM A_DUP) a LEFT JOIN W w ON w.station_id = a.station_id
 AND w.observation_timestamp BETWEEN a.accident_timestamp - INTERVAL 30 MINUTE AND a.accident_timestamp + INTERVAL 30 MINUTE""",
)
def range_join_rows(spark: SparkSession, sf: str) -> DataFrame:
    """JN-3 as a plain left join: rows that share an id, or have none, stay apart."""
    a, w = sub(spark, sf, "A_DUP", "W")
    left = a.select("accident_id", "luminosity", (F.col("luminosity") * 7).cast("string").alias("station_id"), "accident_timestamp")
    right = w.select("station_id", F.col("observation_timestamp").alias("weather_timestamp"))
    return time_range_left_join(left, right, by="station_id", left_ts="accident_timestamp", right_ts="weather_timestamp", tolerance_minutes=30)


@register(
    "weather_asof",
    with_sql(("A", "W"), O.STATIONS, O.NEAREST, O.weather_match(60))
    + "SELECT accident_id, station_id, weather_timestamp, weather_time_difference_minutes, temperature, wind_speed FROM wm",
)
def weather_asof(spark: SparkSession, sf: str) -> DataFrame:
    """JN-4 on its own, with a one-hour tolerance: nearest observation of the nearest station."""
    a, w = sub(spark, sf, "A", "W")
    n = gold.nearest_station(a, gold.stations(w))
    m = nearest_in_time(
        n, w, left_id="accident_id", by="station_id", left_ts="accident_timestamp",
        right_ts="observation_timestamp", right_values=WEATHER_VALUES, tolerance_minutes=60,
        rank_prefix=["distance_to_station_m", "station_id", "station_name", "_s_lat", "_s_lon"],
        diff_col="weather_time_difference_minutes", ts_out="weather_timestamp",
    )
    return m.select(
        "accident_id", "station_id", "weather_timestamp", "weather_time_difference_minutes", "temperature", "wind_speed"
    )


GOLD_SQL = with_sql(("A", "W"), O.STATIONS, O.NEAREST, O.weather_match(120))


@register(
    "gold_accident_weather",
    GOLD_SQL + O.GOLD_SELECT.replace("round(distance_to_station_m, 3)", _DIST) + " FROM wm",
)
def gold_accident_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the Gold table over the accident and weather substrates."""
    a, w = sub(spark, sf, "A", "W")
    g = gold.accident_weather(a, w)
    return g.withColumn("distance_to_station_m", F.round("distance_to_station_m", 3))


_STATE_A, _STATE_W = "ma_state", "mw_state"


JOB_SQL = (
    with_sql(("TGT_A", "STG_A", "TGT_W", "STG_W"), *queries_merge.ACC, *queries_merge.WEA, O.STATIONS.replace("FROM W", f"FROM {_STATE_W}"),
             O.NEAREST.replace("FROM A a", f"FROM {_STATE_A} a"), O.weather_match(120).replace("LEFT JOIN W w", f"LEFT JOIN {_STATE_W} w"))
)


@register(
    "job_load_gold",
    JOB_SQL
    + O.GOLD_SELECT.replace("round(distance_to_station_m, 3)", _DIST)
    + " FROM wm",
)
def job_load_gold(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-3: two loads of accidents and weather, the second merged, and Gold brought up to date: equal to a
    full rebuild from the merged tables."""
    paths = [scratch_path(spark, f"job_{n}") for n in ("accidents", "weather", "gold")]
    for accidents, weather in (("TGT_A", "TGT_W"), ("STG_A", "STG_W")):
        load_and_build_gold(spark, *sub(spark, sf, accidents, weather), *paths)
    return VersionedTable(spark, paths[2]).read().withColumn("distance_to_station_m", F.round("distance_to_station_m", 3))
