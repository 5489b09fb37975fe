"""Registered queries: keyed upserts of the accident and weather tables (UPS-1..4, JN-5/6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.operators import upsert as U
from obsmatch.plans.registry import register, sub, with_sql
from obsmatch.schemas import (
    ACCIDENT_ATTRS,
    ACCIDENT_COLUMNS,
    ACCIDENT_KEYS,
    WEATHER_ATTRS,
    WEATHER_COLUMNS,
    WEATHER_KEYS,
)
from obsmatch.session import materialize, scratch_path
from obsmatch.sources.sinks import VersionedTable, merge_into


def merge_ctes(prefix: str, target: str, staging: str, cols: Sequence[str], keys: Sequence[str], attrs: Sequence[str]) -> list[str]:
    """DuckDB CTEs ``{prefix}_plan`` (action per row) and ``{prefix}_state`` (next target)."""
    t_cols = ", ".join(f"{c} AS t_{c}" for c in cols)
    s_cols = ", ".join(f"{c} AS s_{c}" for c in cols)
    on = " AND ".join(f"t.t_{k} = s.s_{k}" for k in keys)
    changed = " OR ".join(f"t_{a} IS DISTINCT FROM s_{a}" for a in attrs)
    state = ", ".join(f"CASE WHEN _action IN ('insert', 'update') THEN s_{c} ELSE t_{c} END AS {c}" for c in cols)
    return [
        f"""{prefix}_j AS (
    SELECT t.*, s.*, (t._t AND s._s) IS TRUE AS _m, ({changed}) AS _c
    FROM (SELECT {t_cols}, true AS _t, row_number() OVER () AS _tid FROM {target}) t
    FULL OUTER JOIN (SELECT {s_cols}, true AS _s FROM {staging}) s ON {on})""",
        # Per target row: how many staging rows update it; of those that equal it one is enough.
        f"""{prefix}_u AS (
    SELECT *, count_if(_m AND _c) OVER (PARTITION BY _tid) AS _updates, row_number() OVER (PARTITION BY _tid ORDER BY _c DESC) AS _rn
    FROM {prefix}_j)""",
        f"""{prefix}_plan AS (
    SELECT *, CASE WHEN _m AND _c THEN 'update' WHEN _m THEN 'unchanged' WHEN _s THEN 'insert' ELSE 'untouched' END AS _action
    FROM {prefix}_u WHERE NOT _m OR _c OR (_updates = 0 AND _rn = 1))""",
        f"{prefix}_state AS (SELECT {state} FROM {prefix}_plan)",
    ]


def counts_sql(plan: str, keys: Sequence[str]) -> str:
    null_key = " OR ".join(f"s_{k} IS NULL" for k in keys)
    return f"""cast(count_if(_action = 'insert') AS bigint) AS inserted,
       cast(count_if(_action = 'update') AS bigint) AS updated,
       cast(count_if(_action = 'unchanged') AS bigint) AS unchanged,
       cast(count_if(_action = 'untouched') AS bigint) AS untouched,
       cast(count_if(_action IN ('insert', 'update')) AS bigint) AS affected,
       cast(count_if(_action = 'insert' AND ({null_key})) AS bigint) AS null_key_rows FROM {plan}"""


ACC = merge_ctes("ma", "TGT_A", "STG_A", ACCIDENT_COLUMNS, ACCIDENT_KEYS, ACCIDENT_ATTRS)
DUP = merge_ctes("md", "TGT_A", "STG_DUP", ACCIDENT_COLUMNS, ACCIDENT_KEYS, ACCIDENT_ATTRS)
WEA = merge_ctes("mw", "TGT_W", "STG_W", WEATHER_COLUMNS, WEATHER_KEYS, WEATHER_ATTRS)
ACC_REPLAY = merge_ctes("ra", "ma_state", "STG_A", ACCIDENT_COLUMNS, ACCIDENT_KEYS, ACCIDENT_ATTRS)
WEA_REPLAY = merge_ctes("rw", "mw_state", "STG_W", WEATHER_COLUMNS, WEATHER_KEYS, WEATHER_ATTRS)


def _merge(spark: SparkSession, sf: str, tgt: str, stg: str, keys, attrs) -> DataFrame:
    t, s = sub(spark, sf, tgt, stg)
    return U.plan(t, s, keys, attrs)


@register("merge_accidents_state", with_sql(("TGT_A", "STG_A"), *ACC) + "SELECT * FROM ma_state")
def merge_accidents_state(spark: SparkSession, sf: str) -> DataFrame:
    """UPS-1: the accident table after merging the staging rows."""
    return U.next_state(_merge(spark, sf, "TGT_A", "STG_A", ACCIDENT_KEYS, ACCIDENT_ATTRS), ACCIDENT_COLUMNS)


@register("merge_accidents_counts", with_sql(("TGT_A", "STG_A"), *ACC) + "SELECT " + counts_sql("ma_plan", ACCIDENT_KEYS))
def merge_accidents_counts(spark: SparkSession, sf: str) -> DataFrame:
    """UPS-3: rows per action of the accident merge."""
    return U.counts(_merge(spark, sf, "TGT_A", "STG_A", ACCIDENT_KEYS, ACCIDENT_ATTRS), ACCIDENT_KEYS)


@register("merge_weather_state", with_sql(("TGT_W", "STG_W"), *WEA) + "SELECT * FROM mw_state")
def merge_weather_state(spark: SparkSession, sf: str) -> DataFrame:
    """UPS-2: the weather table after merging, composite key (station, hour)."""
    return U.next_state(_merge(spark, sf, "TGT_W", "STG_W", WEATHER_KEYS, WEATHER_ATTRS), WEATHER_COLUMNS)


@register("merge_weather_counts", with_sql(("TGT_W", "STG_W"), *WEA) + "SELECT " + counts_sql("mw_plan", WEATHER_KEYS))
def merge_weather_counts(spark: SparkSession, sf: str) -> DataFrame:
    return U.counts(_merge(spark, sf, "TGT_W", "STG_W", WEATHER_KEYS, WEATHER_ATTRS), WEATHER_KEYS)


@register(
    "merge_replay_counts",
    with_sql(("TGT_A", "STG_A", "TGT_W", "STG_W"), *ACC, *WEA, *ACC_REPLAY, *WEA_REPLAY)
    + "SELECT 'accidents' AS dataset, "
    + counts_sql("ra_plan", ACCIDENT_KEYS)
    + "\nUNION ALL SELECT 'weather' AS dataset, "
    + counts_sql("rw_plan", WEATHER_KEYS),
)
def merge_replay_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Replay: merging the same staging rows again affects no row."""
    out = []
    for name, tgt, stg, cols, keys, attrs in (
        ("accidents", "TGT_A", "STG_A", ACCIDENT_COLUMNS, ACCIDENT_KEYS, ACCIDENT_ATTRS),
        ("weather", "TGT_W", "STG_W", WEATHER_COLUMNS, WEATHER_KEYS, WEATHER_ATTRS),
    ):
        t, s = sub(spark, sf, tgt, stg)
        once = materialize(U.next_state(U.plan(t, s, keys, attrs), cols), "merged")
        twice = U.counts(U.plan(once, s, keys, attrs), keys)
        out.append(twice.select(F.lit(name).alias("dataset"), "*"))
    return out[0].unionByName(out[1])


@register("merge_dup_staging", with_sql(("TGT_A", "STG_DUP"), *DUP) + "SELECT * FROM md_state")
def merge_dup_staging(spark: SparkSession, sf: str) -> DataFrame:
    """UPS-1 with equal and updating staging rows of one key, repeated rows and null keys."""
    return U.next_state(_merge(spark, sf, "TGT_A", "STG_DUP", ACCIDENT_KEYS, ACCIDENT_ATTRS), ACCIDENT_COLUMNS)


@register("merge_dup_counts", with_sql(("TGT_A", "STG_DUP"), *DUP) + "SELECT " + counts_sql("md_plan", ACCIDENT_KEYS))
def merge_dup_counts(spark: SparkSession, sf: str) -> DataFrame:
    return U.counts(_merge(spark, sf, "TGT_A", "STG_DUP", ACCIDENT_KEYS, ACCIDENT_ATTRS), ACCIDENT_KEYS)


@register(
    "initial_load",
    with_sql(("STG_A",))
    + """SELECT count(*) AS inserted, cast(0 AS bigint) AS updated, cast(0 AS bigint) AS unchanged,
       cast(0 AS bigint) AS untouched, count(*) AS affected, cast(count_if(accident_id IS NULL) AS bigint) AS null_key_rows
FROM STG_A""",
)
def initial_load(spark: SparkSession, sf: str) -> DataFrame:
    """UPS-4 / SNK-3: no target yet; what the first load counts."""
    (s,) = sub(spark, sf, "STG_A")
    _, counts = U.upsert(None, s, ACCIDENT_KEYS, ACCIDENT_ATTRS)
    return counts


@register("initial_load_state", with_sql(("STG_DUP",)) + "SELECT * FROM STG_DUP")
def initial_load_state(spark: SparkSession, sf: str) -> DataFrame:
    """UPS-4 / SNK-3: the table after a first load, read back: the staging rows as they are."""
    (s,) = sub(spark, sf, "STG_DUP")
    table = VersionedTable(spark, scratch_path(spark, "first_load"))
    merge_into(table, s, ACCIDENT_KEYS, ACCIDENT_ATTRS)
    return table.read()


_DIFF_ANY = " OR ".join(f"t.{a} IS DISTINCT FROM s.{a}" for a in ACCIDENT_ATTRS)


@register(
    "fn_null_safe_diff",
    with_sql(("TGT_A", "STG_A"))
    + f"""SELECT t.accident_id, t.latitude IS DISTINCT FROM s.latitude AS latitude_changed,
       ({_DIFF_ANY}) AS any_changed
FROM TGT_A t JOIN STG_A s ON t.accident_id = s.accident_id""",
)
def fn_null_safe_diff(spark: SparkSession, sf: str) -> DataFrame:
    """FN-21: ``IS DISTINCT FROM`` per matched key (null vs value, value vs null, equal nulls)."""
    from obsmatch.functions.expr import null_safe_diff

    t, s = sub(spark, sf, "TGT_A", "STG_A")
    j = t.alias("t").join(s.alias("s"), F.col("t.accident_id") == F.col("s.accident_id"))
    any_changed = F.lit(False)
    for a in ACCIDENT_ATTRS:
        any_changed = any_changed | null_safe_diff(F.col(f"t.{a}"), F.col(f"s.{a}"))
    return j.select(
        F.col("t.accident_id").alias("accident_id"),
        null_safe_diff(F.col("t.latitude"), F.col("s.latitude")).alias("latitude_changed"),
        any_changed.alias("any_changed"),
    )
