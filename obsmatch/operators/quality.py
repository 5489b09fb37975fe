"""Data-quality checks over any table of the Gold shape (DQ-1..6).

Violation checks pass when they return no row; metric checks always pass. The reference runs
five warehouse jobs and pulls every violation to the client; here each check is a lazy
DataFrame, ``summary`` folds the three violation counts into one aggregation (one shuffle on
``accident_id`` with a map-side partial aggregate), and ``violation_sample`` keeps the first
rows per check with a window limit instead of collecting them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsmatch.session import materialize

# Fixed values of the reference: the checks, their kind, and their order.
CHECKS: list[tuple[str, str]] = [
    ("duplicate_accidents", "violations"),
    ("invalid_coordinates", "violations"),
    ("missing_timestamps", "violations"),
    ("matching_coverage", "metrics"),
    ("weather_completeness", "metrics"),
]
SAMPLE_ROWS = 10


def _rate(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def invalid_coordinates_flag() -> Column:
    lat, lon = F.col("latitude"), F.col("longitude")
    return lat.isNull() | lon.isNull() | ~lat.between(-90, 90) | ~lon.between(-180, 180)


def missing_timestamps_flag() -> Column:
    return F.col("accident_timestamp").isNull() | F.col("weather_timestamp").isNull()


def duplicate_accidents(gold: DataFrame) -> DataFrame:
    """DQ-1: ids present more than once, with their row count."""
    return gold.groupBy("accident_id").agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def invalid_coordinates(gold: DataFrame) -> DataFrame:
    """DQ-2: missing or out-of-range coordinates."""
    return gold.where(invalid_coordinates_flag()).select("accident_id", "latitude", "longitude")


def missing_timestamps(gold: DataFrame) -> DataFrame:
    """DQ-3: accident or weather timestamp missing."""
    return gold.where(missing_timestamps_flag()).select("accident_id", "accident_timestamp", "weather_timestamp")


def _coverage() -> list[Column]:
    total = F.count(F.lit(1))
    matched = F.count_if(F.col("station_id").isNotNull())
    return [
        total.alias("total_accidents"),
        matched.alias("matched_accidents"),
        F.count_if(F.col("station_id").isNull()).alias("unmatched_accidents"),
        F.round(_rate(matched, total) * 100, 2).alias("matching_rate_pct"),
        F.round(F.avg("distance_to_station_m"), 1).alias("avg_distance_m"),
        F.round(F.max("distance_to_station_m"), 1).alias("max_distance_m"),
        F.round(F.avg("weather_time_difference_minutes"), 1).alias("avg_time_difference_min"),
        F.max("weather_time_difference_minutes").alias("max_time_difference_min"),
    ]


def _completeness() -> list[Column]:
    total = F.count(F.lit(1))
    missing = {c: F.count_if(F.col(c).isNull()) for c in ("temperature", "rainfall_1h", "wind_speed", "wind_direction")}
    return [
        total.alias("total_accidents"),
        missing["temperature"].alias("missing_temperature"),
        missing["rainfall_1h"].alias("missing_rainfall"),
        missing["wind_speed"].alias("missing_wind_speed"),
        missing["wind_direction"].alias("missing_wind_direction"),
        F.round(_rate(missing["temperature"], total) * 100, 2).alias("temperature_null_pct"),
        F.round(_rate(missing["rainfall_1h"], total) * 100, 2).alias("rainfall_null_pct"),
        F.round(_rate(missing["wind_speed"], total) * 100, 2).alias("wind_speed_null_pct"),
    ]


def matching_coverage(gold: DataFrame) -> DataFrame:
    """DQ-4: one row of coverage metrics."""
    return gold.agg(*_coverage())


def weather_completeness(gold: DataFrame) -> DataFrame:
    """DQ-5: null counts of the weather measures; no percentage for wind_direction."""
    return gold.agg(*_completeness())


CHECK_FUNCTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "duplicate_accidents": duplicate_accidents,
    "invalid_coordinates": invalid_coordinates,
    "missing_timestamps": missing_timestamps,
    "matching_coverage": matching_coverage,
    "weather_completeness": weather_completeness,
}


def summary(gold: DataFrame, checks: list[tuple[str, str]] | None = None) -> DataFrame:
    """DQ-6: ``(check, kind, violations, passed)`` per check, in order, from one aggregation.

    Violations pass iff their count is zero; metrics always pass (``violations`` is null);
    an unknown kind raises before any job runs.
    """
    checks = checks or CHECKS
    for name, kind in checks:
        if kind not in ("violations", "metrics"):
            raise ValueError(f"check {name!r} is of kind {kind!r}, not violations or metrics")
        if name not in CHECK_FUNCTIONS:
            raise ValueError(f"Unknown check: {name}")
    per_id = gold.groupBy("accident_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(invalid_coordinates_flag()).alias("inv"),
        F.count_if(missing_timestamps_flag()).alias("mis"),
    )
    counts = per_id.agg(
        F.coalesce(F.count_if(F.col("n") > 1), F.lit(0)).alias("duplicate_accidents"),
        F.coalesce(F.sum("inv"), F.lit(0)).alias("invalid_coordinates"),
        F.coalesce(F.sum("mis"), F.lit(0)).alias("missing_timestamps"),
    )
    rows = []
    for pos, (name, kind) in enumerate(checks):
        v = F.col(name).cast("bigint") if kind == "violations" else F.lit(None).cast("bigint")
        rows.append(F.struct(F.lit(pos).alias("pos"), F.lit(name).alias("check"), F.lit(kind).alias("kind"), v.alias("violations")))
    out = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.select(
        "pos", "check", "kind", "violations",
        F.when(F.col("kind") == "metrics", F.lit(True)).otherwise(F.col("violations") == 0).alias("passed"),
    )


def violation_sample(gold: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """First ``n`` violating ids per violation check, by id: the printed sample of the reference.

    The input is written once, so that its plan does not run for each check."""
    gold = materialize(gold.select("accident_id", "latitude", "longitude", "accident_timestamp", "weather_timestamp"), "dq_input")
    parts = [
        duplicate_accidents(gold).select(F.lit("duplicate_accidents").alias("check"), "accident_id"),
        invalid_coordinates(gold).select(F.lit("invalid_coordinates").alias("check"), "accident_id"),
        missing_timestamps(gold).select(F.lit("missing_timestamps").alias("check"), "accident_id"),
    ]
    allv = parts[0].unionByName(parts[1]).unionByName(parts[2])
    w = Window.partitionBy("check").orderBy(F.col("accident_id").asc_nulls_first())
    return allv.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def run_checks(
    gold: DataFrame, checks: list[tuple[str, str]] | None = None, sample_rows: int = SAMPLE_ROWS
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """DQ-6 runner: the summary, and per check its result (violation checks limited to the first
    ``sample_rows`` ids, by id). The input is written once and every check reads that table; both metric
    checks come from one aggregation. Nothing is collected; the caller decides what to print or fail."""
    checks = checks or CHECKS
    gold = materialize(gold, "dq_input")
    summary_df = summary(gold, checks)
    metrics = None
    results: dict[str, DataFrame] = {}
    for name, kind in checks:
        if kind == "violations":
            results[name] = CHECK_FUNCTIONS[name](gold).orderBy(F.col("accident_id").asc_nulls_first()).limit(sample_rows)
            continue
        if metrics is None:
            both = gold.agg(*[c.alias(f"a{k}") for k, c in enumerate(_coverage())], *[c.alias(f"b{k}") for k, c in enumerate(_completeness())])
            metrics = materialize(both, "dq_metrics")
        side, names = ("a", _names(_coverage(), gold)) if name == "matching_coverage" else ("b", _names(_completeness(), gold))
        results[name] = metrics.select(*[F.col(f"{side}{k}").alias(c) for k, c in enumerate(names)])
    return summary_df, results


def _names(columns: list[Column], df: DataFrame) -> list[str]:
    return df.agg(*columns).columns
