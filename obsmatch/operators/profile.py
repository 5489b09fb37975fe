"""Profile of a raw weather file (PRF-1, DST-2, AGG-5..8): one aggregation pass plus the
distinct stations. Sections whose columns are absent are skipped, as in the reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmatch.schemas import CANDIDATE_WEATHER_COLUMNS
from obsmatch.session import materialize

SAMPLE_ROWS = 5
# The station columns of the raw files.
STATION_COLUMNS = ["NUM_POSTE", "NOM_USUEL", "LAT", "LON"]


def _value(df: DataFrame, c: str, empty_as_null: bool) -> Column:
    col = F.col(c)
    if empty_as_null and dict(df.dtypes)[c] == "string":
        return F.nullif(col, F.lit(""))
    return col


def shape(df: DataFrame) -> DataFrame:
    """AGG-8: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(len(df.columns)).alias("columns"))


def stations(df: DataFrame) -> DataFrame | None:
    """DST-2: distinct raw stations, sorted by id; None when a station column is absent."""
    if not set(STATION_COLUMNS) <= set(df.columns):
        return None
    return df.select(*STATION_COLUMNS).distinct().orderBy("NUM_POSTE", "NOM_USUEL", "LAT", "LON")


def date_range(df: DataFrame) -> DataFrame | None:
    """AGG-5: min and max of the raw hour key."""
    if "AAAAMMJJHH" not in df.columns:
        return None
    return df.agg(F.min("AAAAMMJJHH").alias("min_date"), F.max("AAAAMMJJHH").alias("max_date"))


def candidates(df: DataFrame) -> list[str]:
    return [c for c in CANDIDATE_WEATHER_COLUMNS if c in df.columns]


def non_null_counts(df: DataFrame, empty_as_null: bool = True) -> DataFrame | None:
    """AGG-6: non-null count of each candidate measure present."""
    cols = candidates(df)
    if not cols:
        return None
    return df.agg(*[F.count(_value(df, c, empty_as_null)).alias(c) for c in cols])


def null_percentages(df: DataFrame, empty_as_null: bool = True) -> DataFrame | None:
    """AGG-7: percentage of nulls, rounded to 2 decimals."""
    cols = candidates(df)
    if not cols:
        return None
    return df.agg(
        *[F.round(F.avg(_value(df, c, empty_as_null).isNull().cast("double")) * 100, 2).alias(c) for c in cols]
    )


def schema(df: DataFrame) -> DataFrame:
    """The columns and their types, in order."""
    return df.sparkSession.createDataFrame([(k, c, t) for k, (c, t) in enumerate(df.dtypes)], "position int, column string, type string")


def sample(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows as they come."""
    return df.limit(n)


def report(df: DataFrame, empty_as_null: bool = True) -> dict[str, DataFrame]:
    """PRF-1: every section of the profile whose columns are present, by name.

    All counts come from one aggregation, written as a row; the distinct stations and the sample are
    the only other reads.
    """
    cols = candidates(df)
    dates = "AAAAMMJJHH" in df.columns
    value = {c: _value(df, c, empty_as_null) for c in cols}
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.min("AAAAMMJJHH").alias("min_date"), F.max("AAAAMMJJHH").alias("max_date")] if dates else []
    aggs += [F.count(v).alias(f"n_{c}") for c, v in value.items()]
    aggs += [F.round(F.avg(v.isNull().cast("double")) * 100, 2).alias(f"p_{c}") for c, v in value.items()]
    one = materialize(df.agg(*aggs), "profile")
    sections = {
        "schema": schema(df),
        "sample": sample(df),
        "shape": one.select("rows", F.lit(len(df.columns)).alias("columns")),
        "stations": stations(df),
        "date_range": one.select("min_date", "max_date") if dates else None,
        "non_null": one.select(*[F.col(f"n_{c}").alias(c) for c in cols]) if cols else None,
        "null_pct": one.select(*[F.col(f"p_{c}").alias(c) for c in cols]) if cols else None,
    }
    return {k: v for k, v in sections.items() if v is not None}
