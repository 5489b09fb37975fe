"""Registered queries: the data-quality checks (DQ-1..6) on a Gold table with injected faults.

A fresh Gold table cannot trip the checks (SURVEY Q9), so faults are injected on fixed id
residues in both engines: latitude 91, longitude -181, a lost station, a row written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.operators import quality, quality_state
from obsmatch.plans import gold
from obsmatch.plans import oracle as O
from obsmatch.plans.jobs import load_and_build_gold
from obsmatch.plans.queries_gold import GOLD_SQL, JOB_SQL
from obsmatch.plans.registry import register, sub
from obsmatch.session import materialize, scratch_path
from obsmatch.sources.sinks import VersionedTable

BAD_SQL = (
    GOLD_SQL.rstrip()
    + """,
bad0 AS (SELECT * REPLACE (
    CASE WHEN cast(accident_id AS bigint) % 211 = 0 THEN 91.0 ELSE latitude END AS latitude,
    CASE WHEN cast(accident_id AS bigint) % 223 = 0 THEN -181.0 ELSE longitude END AS longitude,
    CASE WHEN cast(accident_id AS bigint) % 227 = 0 THEN NULL ELSE station_id END AS station_id) FROM wm),
g AS (SELECT * FROM bad0 UNION ALL SELECT * FROM bad0 WHERE cast(accident_id AS bigint) % 307 = 0)
"""
)


def bad_gold(spark: SparkSession, sf: str) -> DataFrame:
    a, w = sub(spark, sf, "A", "W")
    g = materialize(gold.accident_weather(a, w), "gold")  # every check reads the same table
    i = F.col("accident_id").cast("bigint")
    g = g.withColumns(
        {
            "latitude": F.when(i % 211 == 0, F.lit(91.0)).otherwise(F.col("latitude")),
            "longitude": F.when(i % 223 == 0, F.lit(-181.0)).otherwise(F.col("longitude")),
            "station_id": F.when(i % 227 == 0, F.lit(None).cast("string")).otherwise(F.col("station_id")),
        }
    )
    return g.unionByName(g.where(i % 307 == 0))


def _r(expr: str, digits: int) -> str:
    return O.spark_round(expr, digits)


def _rate(part: str) -> str:
    return f"CASE WHEN count(*) = 0 THEN NULL ELSE cast({part} AS double) / cast(count(*) AS double) END"


@register(
    "dq_duplicate_accidents",
    BAD_SQL + "SELECT accident_id, count(*) AS row_count FROM g GROUP BY accident_id HAVING count(*) > 1",
)
def dq_duplicate_accidents(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_accidents(bad_gold(spark, sf))


@register(
    "dq_invalid_coordinates",
    BAD_SQL
    + """SELECT accident_id, latitude, longitude FROM g
WHERE latitude IS NULL OR longitude IS NULL OR latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180""",
)
def dq_invalid_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.invalid_coordinates(bad_gold(spark, sf))


@register(
    "dq_missing_timestamps",
    BAD_SQL
    + "SELECT accident_id, accident_timestamp, weather_timestamp FROM g WHERE accident_timestamp IS NULL OR weather_timestamp IS NULL",
)
def dq_missing_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_timestamps(bad_gold(spark, sf))


_COVERAGE = f"""SELECT count(*) AS total_accidents,
       cast(count_if(station_id IS NOT NULL) AS bigint) AS matched_accidents,
       cast(count_if(station_id IS NULL) AS bigint) AS unmatched_accidents,
       {_r(_rate('count_if(station_id IS NOT NULL)') + ' * 100', 2)} AS matching_rate_pct,
       {_r('avg(distance_to_station_m)', 1)} AS avg_distance_m,
       {_r('max(distance_to_station_m)', 1)} AS max_distance_m,
       {_r('avg(weather_time_difference_minutes)', 1)} AS avg_time_difference_min,
       max(weather_time_difference_minutes) AS max_time_difference_min"""
_COMPLETENESS = f"""       cast(count_if(temperature IS NULL) AS bigint) AS missing_temperature,
       cast(count_if(rainfall_1h IS NULL) AS bigint) AS missing_rainfall,
       cast(count_if(wind_speed IS NULL) AS bigint) AS missing_wind_speed,
       cast(count_if(wind_direction IS NULL) AS bigint) AS missing_wind_direction,
       {_r(_rate('count_if(temperature IS NULL)') + ' * 100', 2)} AS temperature_null_pct,
       {_r(_rate('count_if(rainfall_1h IS NULL)') + ' * 100', 2)} AS rainfall_null_pct,
       {_r(_rate('count_if(wind_speed IS NULL)') + ' * 100', 2)} AS wind_speed_null_pct"""


@register(
    "dq_matching_coverage",
    BAD_SQL
    + f"""{_COVERAGE}
FROM g""",
)
def dq_matching_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return quality.matching_coverage(bad_gold(spark, sf))


@register(
    "dq_weather_completeness",
    BAD_SQL
    + f"""SELECT count(*) AS total_accidents,
{_COMPLETENESS}
FROM g""",
)
def dq_weather_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.weather_completeness(bad_gold(spark, sf))


@register(
    "dq_summary",
    BAD_SQL
    + """, per_id AS (
    SELECT accident_id, count(*) AS n,
           count_if(latitude IS NULL OR longitude IS NULL OR latitude NOT BETWEEN -90 AND 90
                    OR longitude NOT BETWEEN -180 AND 180) AS inv,
           count_if(accident_timestamp IS NULL OR weather_timestamp IS NULL) AS mis
    FROM g GROUP BY accident_id),
c AS (SELECT cast(count_if(n > 1) AS bigint) AS d, cast(coalesce(sum(inv), 0) AS bigint) AS i,
             cast(coalesce(sum(mis), 0) AS bigint) AS m FROM per_id)
SELECT 0 AS pos, 'duplicate_accidents' AS "check", 'violations' AS kind, d AS violations, d = 0 AS passed FROM c
UNION ALL SELECT 1, 'invalid_coordinates', 'violations', i, i = 0 FROM c
UNION ALL SELECT 2, 'missing_timestamps', 'violations', m, m = 0 FROM c
UNION ALL SELECT 3, 'matching_coverage', 'metrics', NULL, true FROM c
UNION ALL SELECT 4, 'weather_completeness', 'metrics', NULL, true FROM c""",
)
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.summary(bad_gold(spark, sf))


@register(
    "dq_violation_sample",
    BAD_SQL
    + """, v AS (
    SELECT 'duplicate_accidents' AS "check", accident_id FROM g GROUP BY accident_id HAVING count(*) > 1
    UNION ALL SELECT 'invalid_coordinates', accident_id FROM g
      WHERE latitude IS NULL OR longitude IS NULL OR latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180
    UNION ALL SELECT 'missing_timestamps', accident_id FROM g WHERE accident_timestamp IS NULL OR weather_timestamp IS NULL)
SELECT "check", accident_id, rank FROM (
  SELECT "check", accident_id, row_number() OVER (PARTITION BY "check" ORDER BY accident_id NULLS FIRST) AS rank FROM v)
WHERE rank <= 10""",
)
def dq_violation_sample(spark: SparkSession, sf: str) -> DataFrame:
    return quality.violation_sample(bad_gold(spark, sf))


@register(
    "job_load_metrics",
    JOB_SQL
    + f"""{_COVERAGE},
{_COMPLETENESS},
       (SELECT count(*) FROM (SELECT accident_id FROM wm GROUP BY accident_id HAVING count(*) > 1)) AS duplicate_accidents,
       cast(count_if(latitude IS NULL OR longitude IS NULL OR latitude NOT BETWEEN -90 AND 90
                     OR longitude NOT BETWEEN -180 AND 180) AS bigint) AS invalid_coordinates,
       cast(count_if(accident_timestamp IS NULL OR weather_timestamp IS NULL) AS bigint) AS missing_timestamps
FROM wm""",
)
def job_load_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """JOB-3 and DQ-1..5: two loads, after each of which the state of the checks follows Gold by its changed buckets; read
    from the state, equal to all checks on the whole of Gold."""
    paths = [scratch_path(spark, f"job_{n}") for n in ("accidents", "weather", "gold", "metrics")]
    for accidents, weather in (("TGT_A", "TGT_W"), ("STG_A", "STG_W")):
        load_and_build_gold(spark, *sub(spark, sf, accidents, weather), *paths[:3], metrics_table=paths[3])
    return quality_state.all_metrics(VersionedTable(spark, paths[3]).read())
