"""Reference-shaped tables derived from the driver's tables (FIXTURES.md §4).

The driver has no accident or weather files, so accidents are derived from ``orders``, hourly
observations from ``events`` and the resource catalog from ``pages``. One SQL text serves Spark
and DuckDB: ``{TS}`` is the zone-less timestamp type and ``{LONG}`` the quoted ``long`` column.
Every row of the base tables yields a row, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# name -> (SQL, tables or substrates it reads)
SUBSTRATES: dict[str, tuple[str, tuple[str, ...]]] = {
    "A": (
        """
select cast(o_orderkey as string) as accident_id,
       case when o_orderkey % 97 = 0 then null
            else cast('2024-01-01 00:00:00' as {TS}) + ((o_orderkey * 7919) % 43200) * interval '1' minute end as accident_timestamp,
       lpad(cast(o_custkey % 5 + 1 as string), 2, '0') as department,
       concat('C', cast(o_custkey % 200 as string)) as city,
       case when o_orderkey % 53 = 0 then null
            else cast(41 as double) + cast((o_orderkey * 104729) % 10007 as double) / cast(1000 as double) end as latitude,
       cast(-5 as double) + cast((o_custkey * 7919) % 14009 as double) / cast(1000 as double) as longitude,
       case when o_orderkey % 31 = 0 then null else cast(o_orderkey % 9 + 1 as bigint) end as atmospheric_condition,
       cast(o_orderkey % 5 + 1 as bigint) as luminosity,
       cast(o_orderkey % 7 + 1 as bigint) as collision_type
from {orders}
""",
        ("orders",),
    ),
    # Repeated ids (several orders of a customer) and null ids.
    "A_DUP": (
        """
select case when cast(accident_id as bigint) % 41 = 0 then null
            when cast(accident_id as bigint) % 6 = 0 then city else accident_id end as accident_id,
       accident_timestamp, department, city, latitude, longitude, atmospheric_condition, luminosity, collision_type
from {A}
""",
        ("A",),
    ),
    # Staging rows equal to their target and one that differs, repeated rows, null keys.
    "STG_DUP": (
        """
select case when cast(accident_id as bigint) % 17 = 0 then null else accident_id end as accident_id,
       accident_timestamp, department, city, latitude, longitude, atmospheric_condition, luminosity, collision_type
from {A} where cast(accident_id as bigint) % 5 <> 0
union all
select accident_id, accident_timestamp, department, city, latitude, longitude, atmospheric_condition,
       case when cast(accident_id as bigint) % 4 = 0 then luminosity + 1 else luminosity end as luminosity, collision_type
from {A} where cast(accident_id as bigint) % 2 = 0
""",
        ("A",),
    ),
    "W": (
        """
select cast(user_id % 50 as string) as station_id,
       concat('S', cast(user_id % 50 as string)) as station_name,
       '01' as department,
       ts as observation_timestamp,
       case when user_id % 50 = 7 then null
            else cast(41 as double) + cast((user_id % 50 * 6151) % 9973 as double) / cast(1000 as double) end as latitude,
       cast(-5 as double) + cast((user_id % 50 * 3571) % 13999 as double) / cast(1000 as double) as longitude,
       case when event_type = 'error' then null else value end as temperature,
       case when event_id % 4 = 0 then null else value / cast(10 as double) end as rainfall_1h,
       case when event_id % 2 = 0 then null else cast(event_id % 30 as double) end as wind_speed,
       cast(event_id % 36 * 10 as double) as wind_direction
from {events}
""",
        ("events",),
    ),
    "A_RAW": (
        """
select cast(o_orderkey as string) as Num_Acc,
       cast(1 + cast(floor(t / cast(1440 as double)) as int) as string) as jour,
       '1' as mois, '2024' as an,
       case when o_orderkey % 101 = 0 then '2460' when o_orderkey % 103 = 0 then '12345'
            when o_orderkey % 4 = 0 then concat(lpad(cast(h as string), 2, '0'), ':', lpad(cast(m as string), 2, '0'))
            when o_orderkey % 4 = 1 then cast(h * 100 + m as string)
            when o_orderkey % 4 = 2 then concat(' ', lpad(cast(h as string), 2, '0'), ':', lpad(cast(m as string), 2, '0'), ' ')
            else concat(cast(h as string), ':', lpad(cast(m as string), 2, '0')) end as hrmn,
       cast(o_orderkey % 5 + 1 as string) as lum,
       case when o_custkey % 7 = 0 then '2A' else lpad(cast(o_custkey % 5 + 1 as string), 2, '0') end as dep,
       concat('C', cast(o_custkey % 200 as string)) as com,
       case when o_orderkey % 31 = 0 then '' when o_orderkey % 37 = 0 then 'x' else cast(o_orderkey % 9 + 1 as string) end as atm,
       cast(o_orderkey % 7 - 1 as string) as col,
       case when o_orderkey % 53 = 0 then null when o_orderkey % 59 = 0 then 'n/a'
            else concat(cast(41 + cast(floor(y / cast(1000 as double)) as int) as string), ',', lpad(cast(y % 1000 as string), 3, '0')) end as lat,
       concat(' ', case when x < 0 then '-' else '' end, cast(cast(floor(abs(x) / cast(1000 as double)) as int) as string), ',',
              lpad(cast(abs(x) % 1000 as string), 3, '0')) as {LONG}
from (select o_orderkey, o_custkey, t, y, x, cast(floor((t % 1440) / cast(60 as double)) as int) as h, cast(t % 60 as int) as m
      from (select o_orderkey, o_custkey, (o_orderkey * 7919) % 43200 as t, (o_orderkey * 104729) % 10007 as y,
                   (o_custkey * 7919) % 14009 - 5000 as x from {orders}) q) r
""",
        ("orders",),
    ),
    "W_RAW": (
        """
select lpad(cast(user_id % 50 as string), 8, '0') as NUM_POSTE,
       concat('S', cast(user_id % 50 as string)) as NOM_USUEL,
       case when user_id % 50 = 7 then '' else concat('4', cast(user_id % 10 as string), '.', lpad(cast((user_id % 50 * 6151) % 1000 as string), 3, '0')) end as LAT,
       concat(cast(user_id % 9 as string), '.', lpad(cast((user_id % 50 * 3571) % 1000 as string), 3, '0')) as LON,
       case when event_id % 211 = 0 then '2024013025'
            else concat(cast(year(ts) - case when event_id % 13 = 0 then 1 else 0 end as string), lpad(cast(month(ts) as string), 2, '0'),
                        lpad(cast(day(ts) as string), 2, '0'), lpad(cast(hour(ts) as string), 2, '0')) end as AAAAMMJJHH,
       case when event_type = 'error' then '' else concat(cast(event_id % 35 as string), '.', cast(event_id % 10 as string)) end as T,
       case when event_id % 4 = 0 then null else concat('0.', cast(event_id % 10 as string)) end as RR1,
       case when event_id % 2 = 0 then null else cast(event_id % 30 as string) end as FF,
       cast(event_id % 36 * 10 as string) as DD
from {events}
""",
        ("events",),
    ),
    "TGT_A": ("select * from {A} where cast(accident_id as bigint) % 3 <> 0", ("A",)),
    "STG_A": (
        """
select accident_id, accident_timestamp, department, city,
       case when cast(accident_id as bigint) % 7 = 0 then null else latitude end as latitude,
       longitude, atmospheric_condition, luminosity, collision_type
from {A} where cast(accident_id as bigint) % 5 <> 0
""",
        ("A",),
    ),
    "W_HOURLY": (
        """
select station_id, max(station_name) as station_name, max(department) as department,
       cast(date_trunc('hour', observation_timestamp) as {TS}) as observation_timestamp,
       max(latitude) as latitude, max(longitude) as longitude, min(temperature) as temperature,
       max(rainfall_1h) as rainfall_1h, max(wind_speed) as wind_speed, max(wind_direction) as wind_direction
from {W} group by station_id, cast(date_trunc('hour', observation_timestamp) as {TS})
""",
        ("W",),
    ),
    "TGT_W": ("select * from {W_HOURLY} where day(observation_timestamp) <= 20", ("W_HOURLY",)),
    "STG_W": (
        """
select station_id, station_name, department, observation_timestamp, latitude, longitude,
       case when hour(observation_timestamp) = 12 then cast(-1 as double) else temperature end as temperature,
       rainfall_1h, wind_speed, wind_direction
from {W_HOURLY} where day(observation_timestamp) >= 15
""",
        ("W_HOURLY",),
    ),
    "CAT": (
        """
select page_id as id,
       case when page_id % 3 = 0 then concat('HOR_departement_', lpad(cast(page_id % 12 as string), 2, '0'), '_periode_',
                  cast(1990 + (page_id % 4) * 10 as string), '-', cast(1999 + (page_id % 4) * 10 as string))
            when page_id % 3 = 1 then concat(case page_id % 5 when 0 then 'Caracteristiques-' when 1 then 'lieux-' when 2 then 'vehicules-'
                  when 3 then 'vehicules-immatricules-' else 'usagers-' end, cast(2000 + page_id % 25 as string))
            else '' end as title,
       concat('n', cast(page_id as string)) as name,
       case page_id % 4 when 0 then 'csv' when 1 then 'CSV' when 2 then 'csv.gz' else null end as format,
       url
from {pages}
""",
        ("pages",),
    ),
}

BASE_TABLES = ("orders", "events", "pages")


def _order(names: tuple[str, ...]) -> list[str]:
    """Substrates needed by ``names``, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in out:
            return
        for dep in SUBSTRATES[n][1]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def substrate(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The substrate as a Spark DataFrame over the parquet tables in ``sf_dir``."""
    frames: dict[str, DataFrame] = {}
    for n in _order((name,)):
        sql, deps = SUBSTRATES[n]
        args = {}
        for d in deps:
            if d in BASE_TABLES:
                args[d] = spark.read.parquet(f"{sf_dir}/{d}.parquet")
            else:
                args[d] = frames[d]
        text = sql.replace("{TS}", "timestamp_ntz").replace("{LONG}", "`long`")
        frames[n] = spark.sql(text, **args)
    return frames[name]


def duckdb_with(*names: str) -> str:
    """``WITH`` clause defining the substrates for DuckDB, over its pre-registered views."""
    parts = []
    for n in _order(names):
        sql, deps = SUBSTRATES[n]
        text = sql.replace("{TS}", "timestamp").replace("{LONG}", '"long"')
        for d in deps:
            text = text.replace("{" + d + "}", d)
        parts.append(f"{n} AS ({text.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"
