"""Keyed, change-detecting upsert (UPS-1..4): the reference's MERGE without a table format.

``plan`` is one full outer join of target and staging on the keys with an action per row:

* ``insert``    -- staging row with no target match (null keys never match: inserted each time);
* ``update``    -- matched and some attribute ``IS DISTINCT FROM`` the staging value;
* ``unchanged`` -- matched, all attributes equal (NaN equals NaN, null equals null);
* ``untouched`` -- target row no staging row matches. Nothing is ever deleted.

A target row that more than one staging row would update is an error, as in the reference's
warehouse; staging rows equal to the target row are no updates, and keep it once. Whether that is so follows from
one row per repeated key: its number of rows and of distinct attribute values, and the least and greatest of these with
their numbers of rows (partial aggregates; no window sorts the staging rows). Keys that staging has once are not in that
table, so it is mostly empty and adaptive execution broadcasts it. Equal staging rows meet as one row and a count before
any exchange on the key, so a row repeated many times is no hot key; rows with a null key are salted by a hash of the
row (the same on every retry) so that they cannot gather in one task.

``sinks.merge_into`` writes ``changes`` of one such plan: the next state and what happened to each row, counted by the
same write.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmatch.functions.expr import null_safe_diff

# Partitions over which rows with a null key are scattered.
NULL_KEY_SPREAD = 4096
# Copies of a row that one array makes; a row repeated more often takes several.
COPIES = 1 << 20
# What a merge did to a row of the state it wrote.
CHANGE = "_change"


def _any(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols, F.lit(False))


def plan(target: DataFrame, staging: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Every target and staging row with its ``_action``; columns ``t_*`` and ``s_*``."""
    cols = list(target.columns)
    missing = [c for c in [*keys, *attrs] if c not in cols or c not in staging.columns]
    if missing:
        raise ValueError(f"upsert columns missing: {missing}")
    null_key = _any([F.col(k).isNull() for k in keys])
    others = [c for c in cols if c not in keys and c not in attrs]
    t_cols, s_cols = [f"t_{c}" for c in cols], [f"s_{c}" for c in cols]

    def values(prefix: str = "") -> Column:
        return F.struct(*[F.col(f"{prefix}{a}").alias(a) for a in attrs])

    # Null keys never match, but they all hash to one partition of a full outer join, which AQE cannot split. A salt that
    # is 0 for real keys and spread for null keys keeps matching unchanged and scatters those rows.
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(NULL_KEY_SPREAD))
    salt = F.when(null_key, spread).otherwise(F.lit(0)).cast("int")
    s = staging.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    by_value = s if not others else s.groupBy(*keys, *attrs).agg(F.sum("_copies").alias("_copies"), F.min(F.struct(*others)).alias("_least"))
    one = F.struct(values().alias("value"), F.col("_copies").alias("n"))
    least = F.min(F.struct(values().alias("value"), "_least")) if others else F.lit(None)
    repeated = (
        by_value.where(~null_key).groupBy(*[F.col(k).alias(f"k_{k}") for k in keys])
        .agg(F.sum("_copies").alias("_n"), F.count(F.lit(1)).alias("_values"), F.min(one).alias("_lo"), F.max(one).alias("_hi"), least.alias("_first"))
        .where(F.col("_n") > 1)
    )
    s = s.select(*[F.col(c).alias(f"s_{c}") for c in cols], "_copies", F.lit(True).alias("_s"), salt.alias("_ss"))
    s = s.join(repeated, [F.col(f"s_{k}") == F.col(f"k_{k}") for k in keys], "left")
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_t"), salt.alias("_ts"))
    on = reduce(lambda a, b: a & b, [t[f"t_{k}"] == s[f"s_{k}"] for k in keys], t["_ts"] == s["_ss"])
    j = t.join(s, on, "full_outer")

    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    changed = _any([null_safe_diff(f"t_{a}", f"s_{a}") for a in attrs])

    def updates_of(end: str) -> Column:
        return F.when(values("t_").eqNullSafe(F.col(f"{end}.value")), F.lit(0)).otherwise(F.col(f"{end}.n"))

    # How many staging rows of the key would update the target row; of three values at least two differ from it.
    updates = (
        F.when(F.col("_n").isNull(), changed.cast("bigint"))
        .when(F.col("_values") == 1, updates_of("_lo"))
        .when(F.col("_values") == 2, updates_of("_lo") + updates_of("_hi"))
        .otherwise(F.lit(2))
    )
    action = (
        F.when(matched & (updates > 1), F.raise_error(F.lit("MERGE: a target row matches several updating staging rows")))
        .when(matched & changed, F.lit("update"))
        .when(matched, F.lit("unchanged"))
        .when(F.col("_s").isNotNull(), F.lit("insert"))
        .otherwise(F.lit("untouched"))
    )
    # A target row equal to all its staging rows is kept once: by the first of them.
    first = F.struct(*[F.col(f"s_{c}").alias(c) for c in others]).eqNullSafe(F.col("_first._least")) if others else F.lit(True)
    keep = ~matched | changed | ((updates == 0) & (F.col("_n").isNull() | first))
    out = j.where(keep).withColumn("_action", action)
    # Staging rows without a target are inserted as often as they come.
    copies = F.when(F.col("_action") == "insert", F.col("_copies")).otherwise(F.lit(1))
    out = out.withColumn("_left", copies).withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_left") - 1) / COPIES).cast("int"))))
    here = F.least(F.lit(COPIES), F.col("_left") - F.col("_part").cast("bigint") * COPIES).cast("int")
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), here))).select(*t_cols, "_t", *s_cols, "_s", "_action")


def next_state(planned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The target after the merge, in the target's column order."""
    take_s = F.col("_action").isin("insert", "update")
    return planned.select(
        *[F.when(take_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in columns]
    )


def changes(planned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The target after the merge with what happened to each row, as ``CHANGE``."""
    take_s = F.col("_action").isin("insert", "update")
    return planned.select(*[F.when(take_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in columns], F.col("_action").alias(CHANGE))


def change_counts(keys: Sequence[str]) -> list[Column]:
    """:func:`count_columns` over ``changes``."""
    return count_columns(keys, CHANGE, "")


def count_columns(keys: Sequence[str], action: str = "_action", prefix: str = "s_") -> list[Column]:
    """Aggregates over a plan: rows per action, ``affected`` (= inserted + updated, the DML
    count) and the inserted rows with a null key, which a replay inserts again."""
    a = F.col(action)
    null_key = _any([F.col(f"{prefix}{k}").isNull() for k in keys])
    return [
        F.count_if(a == "insert").alias("inserted"),
        F.count_if(a == "update").alias("updated"),
        F.count_if(a == "unchanged").alias("unchanged"),
        F.count_if(a == "untouched").alias("untouched"),
        F.count_if(a.isin("insert", "update")).alias("affected"),
        F.count_if((a == "insert") & null_key).alias("null_key_rows"),
    ]


def counts(planned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of :func:`count_columns`."""
    return planned.agg(*count_columns(keys))


def upsert(
    target: DataFrame | None, staging: DataFrame, keys: Sequence[str], attrs: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """UPS-4: first load copies staging as is (no dedupe); later loads merge.

    Returns ``(next_state, counts)``, both lazy and from one plan.
    """
    if target is None:
        state = staging
        c = staging.agg(
            F.count(F.lit(1)).alias("inserted"),
            F.lit(0).cast("bigint").alias("updated"),
            F.lit(0).cast("bigint").alias("unchanged"),
            F.lit(0).cast("bigint").alias("untouched"),
            F.count(F.lit(1)).alias("affected"),
            F.count_if(_any([F.col(k).isNull() for k in keys])).alias("null_key_rows"),
        )
        return state, c
    p = plan(target, staging, keys, attrs)
    return next_state(p, target.columns), counts(p, keys)
