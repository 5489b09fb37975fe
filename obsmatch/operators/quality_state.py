"""Mergeable quality metrics: DQ-1..6 kept by buckets of accident ids and replaced only where Gold changed.

Each check is a sum, a count or a maximum over rows or, for repeated ids, over ids. Ids are dealt to buckets by hash, so all
rows of an id share a bucket and everything adds up over buckets: a state has one narrow row a bucket, whatever the size of
Gold. A refresh computes the touched buckets anew and keeps the others. Nothing is ever subtracted, so maxima stay right and
sums of doubles do not drift. Changed rows are counted once for each id before they are counted for a bucket, both with partial
aggregates, so an id (or the null id) with a third of all rows is no hot group.

Defined cases: rows with a null id are one group, as in DQ-1; an empty Gold has an empty state, which folds to zero counts and
null averages, as the checks on it do; a bucket that lost its last row leaves the state; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmatch.operators.quality import CHECKS, invalid_coordinates_flag, missing_timestamps_flag

#: Rows of a state. More buckets make a refresh read less where few ids changed.
BUCKETS = 1024

#: The count that holds the violations of a check.
VIOLATIONS = {"duplicate_accidents": "repeated", "invalid_coordinates": "invalid", "missing_timestamps": "undated"}
_MEASURES = ("temperature", "rainfall_1h", "wind_speed", "wind_direction")
_COUNTS = ["n", "matched", "distances", "differences", "invalid", "undated", *[f"no_{m}" for m in _MEASURES]]
_SUMS = ["distance_sum", "difference_sum"]
_MAXIMA = ["distance_max", "difference_max"]


def bucket_of(column: str = "accident_id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def partials(gold: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row for each bucket that has rows: counts, sums and maxima, and the number of repeated ids."""
    distance, difference = F.col("distance_to_station_m"), F.col("weather_time_difference_minutes")
    per_id = gold.groupBy("accident_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("station_id").alias("matched"),
        F.count(distance).alias("distances"),
        F.count(difference).alias("differences"),
        F.count_if(invalid_coordinates_flag()).alias("invalid"),
        F.count_if(missing_timestamps_flag()).alias("undated"),
        *[F.count_if(F.col(m).isNull()).alias(f"no_{m}") for m in _MEASURES],
        F.sum(distance).alias("distance_sum"),
        F.sum(difference).alias("difference_sum"),
        F.max(distance).alias("distance_max"),
        F.max(difference).alias("difference_max"),
    )
    return per_id.groupBy(bucket_of(buckets=buckets).alias("bucket")).agg(
        *[F.sum(c).alias(c) for c in [*_COUNTS, *_SUMS]],
        *[F.max(c).alias(c) for c in _MAXIMA],
        F.count_if(F.col("n") > 1).alias("repeated"),
    )


def refresh(state: DataFrame, gold: DataFrame, changed_ids: DataFrame, id_column: str = "accident_id", buckets: int = BUCKETS) -> DataFrame:
    """The state of ``gold``, where ``state`` is that of an earlier Gold with the same ``buckets``.

    ``changed_ids`` names at least the ids whose rows came, went or changed. Gold is scanned for the columns of the checks; only rows
    of touched buckets are shuffled."""
    touched = changed_ids.select(bucket_of(id_column, buckets).alias("_bucket")).distinct()
    touched = F.broadcast(touched)  # ``buckets`` integers at most
    again = gold.join(touched, bucket_of(buckets=buckets) == F.col("_bucket"), "left_semi")
    kept = state.join(touched, F.col("bucket") == F.col("_bucket"), "left_anti")
    return kept.unionByName(partials(again, buckets))


def _total(state: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return state.agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in [*_COUNTS, "repeated"]],
        *[F.sum(c).alias(c) for c in _SUMS],
        *[F.max(c).alias(c) for c in _MAXIMA],
    )


def _share(part: str) -> Column:
    return F.round(F.try_divide(F.col(part).cast("double"), F.col("n").cast("double")) * 100, 2)


def _mean(total: str, count: str) -> Column:
    return F.round(F.try_divide(F.col(total).cast("double"), F.col(count).cast("double")), 1)


def _coverage() -> list[Column]:
    return [
        F.col("n").alias("total_accidents"),
        F.col("matched").alias("matched_accidents"),
        (F.col("n") - F.col("matched")).alias("unmatched_accidents"),
        _share("matched").alias("matching_rate_pct"),
        _mean("distance_sum", "distances").alias("avg_distance_m"),
        F.round("distance_max", 1).alias("max_distance_m"),
        _mean("difference_sum", "differences").alias("avg_time_difference_min"),
        F.col("difference_max").alias("max_time_difference_min"),
    ]


def _completeness() -> list[Column]:
    return [
        F.col("no_temperature").alias("missing_temperature"),
        F.col("no_rainfall_1h").alias("missing_rainfall"),
        F.col("no_wind_speed").alias("missing_wind_speed"),
        F.col("no_wind_direction").alias("missing_wind_direction"),
        _share("no_temperature").alias("temperature_null_pct"),
        _share("no_rainfall_1h").alias("rainfall_null_pct"),
        _share("no_wind_speed").alias("wind_speed_null_pct"),
    ]


def matching_coverage(state: DataFrame) -> DataFrame:
    """DQ-4 from a state."""
    return _total(state).select(*_coverage())


def weather_completeness(state: DataFrame) -> DataFrame:
    """DQ-5 from a state."""
    return _total(state).select(F.col("n").alias("total_accidents"), *_completeness())


def all_metrics(state: DataFrame) -> DataFrame:
    """DQ-1..5 from a state as one row: both kinds of metrics and the number of violations of each check."""
    counts = [F.col(c).alias(name) for name, c in VIOLATIONS.items()]
    return _total(state).select(*_coverage(), *_completeness(), *counts)


def summary(state: DataFrame) -> DataFrame:
    """DQ-6 from a state: ``(pos, check, kind, violations, passed)`` of every check, in order."""
    rows = [
        F.struct(
            F.lit(pos).alias("pos"),
            F.lit(name).alias("check"),
            F.lit(kind).alias("kind"),
            (F.col(VIOLATIONS[name]) if name in VIOLATIONS else F.lit(None)).cast("bigint").alias("violations"),
        )
        for pos, (name, kind) in enumerate(CHECKS)
    ]
    out = _total(state).select(F.inline(F.array(*rows)))
    return out.withColumn("passed", F.coalesce(F.col("violations") == 0, F.lit(True)))
