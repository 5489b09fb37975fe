"""DuckDB SQL building blocks for the correctness oracle.

Each registered query has an SQL twin run by DuckDB over the same Parquet tables; the
substrates come in as CTEs (``fixtures.duckdb_with``). Conventions that keep both engines on the
same values: distances rounded to 3 decimals, whole minutes with ``date_sub`` (truncating, like
Spark's ``timestampdiff``), ``count_if`` cast to BIGINT, and Spark's rounding -- half up on the
shortest decimal form of the double -- reproduced through a DECIMAL cast.
"""

from __future__ import annotations


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(2 * 6371010.0 * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))"
    )


def spark_round(expr: str, digits: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on the shortest decimal representation."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38, 18)), {digits}) as double)"


ACC_COLS = [
    "accident_id", "accident_timestamp", "department", "city", "latitude", "longitude",
    "atmospheric_condition", "luminosity", "collision_type",
]
ACC_TIE = ", ".join(f"a.{c} NULLS FIRST" for c in ACC_COLS[1:])

STATIONS = """stations AS (
    SELECT DISTINCT station_id, station_name, latitude, longitude FROM W
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"""

NEAREST = f"""ns AS (
    SELECT a.*, s.station_id, s.station_name, s.latitude AS s_lat, s.longitude AS s_lon,
           {haversine('a.latitude', 'a.longitude', 's.latitude', 's.longitude')} AS distance_to_station_m
    FROM A a CROSS JOIN stations s
    WHERE a.latitude IS NOT NULL AND a.longitude IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY a.accident_id ORDER BY distance_to_station_m, s.station_id,
            s.station_name, s.latitude, s.longitude, {ACC_TIE}) = 1)"""


def weather_match(tolerance_minutes: int = 120) -> str:
    return f"""wm AS (
    SELECT n.accident_id, n.accident_timestamp, n.department, n.city, n.latitude, n.longitude,
           n.atmospheric_condition, n.luminosity, n.collision_type, n.station_id, n.station_name,
           n.distance_to_station_m, w.observation_timestamp AS weather_timestamp, w.temperature,
           w.rainfall_1h, w.wind_speed, w.wind_direction,
           abs(date_sub('minute', n.accident_timestamp, w.observation_timestamp)) AS weather_time_difference_minutes
    FROM ns n LEFT JOIN W w
      ON w.station_id = n.station_id
     AND w.observation_timestamp BETWEEN n.accident_timestamp - INTERVAL {tolerance_minutes} MINUTE
                                     AND n.accident_timestamp + INTERVAL {tolerance_minutes} MINUTE
    QUALIFY row_number() OVER (PARTITION BY n.accident_id ORDER BY weather_time_difference_minutes,
            w.observation_timestamp, w.temperature NULLS FIRST, w.rainfall_1h NULLS FIRST,
            w.wind_speed NULLS FIRST, w.wind_direction NULLS FIRST) = 1)"""


GOLD_SELECT = """SELECT accident_id, accident_timestamp, department, city, latitude, longitude,
       atmospheric_condition, luminosity, collision_type, station_id, station_name,
       round(distance_to_station_m, 3) AS distance_to_station_m, weather_timestamp, temperature,
       rainfall_1h, wind_speed, wind_direction, weather_time_difference_minutes"""
