"""Gold ``accident_weather`` (JOB-3 last step, SNK-4): one row per accident with its nearest
station and that station's nearest observation within the tolerance.

Plan, with the shuffles it costs:

1. Distinct stations from the weather table (partial aggregate before the shuffle), written once
   as a table; the same write observes their count and the cell-size statistics.
2. Nearest station per accident: cell candidates joined to the accidents, then ``array_min`` in
   place (``nearest``).
3. One row per accident id (SURVEY Q10/Q11), written once as a table; the write observes the time
   range.
4. The weather rows are pruned before any shuffle: that time range (pushed to the Parquet
   scan) and a semi-join on the stations actually chosen.
5. As-of by hour buckets on narrow pairs, reduced per id before the shuffle; the accident row
   joins back once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmatch.operators.asof import nearest_in_time, time_range_semi_join
from obsmatch.operators.nearest import PreparedSites, nearest, prepare_sites
from obsmatch.schemas import ACCIDENT_COLUMNS, GOLD_COLUMNS, WEATHER_VALUES
from obsmatch.session import materialize, materialize_observed

STATION_COLUMNS = ["station_id", "station_name", "latitude", "longitude"]
# Fixed value of the reference: an observation may be up to two hours before or after.
TOLERANCE_MINUTES = 120


def stations(weather: DataFrame) -> DataFrame:
    """DST-1: distinct (station_id, station_name, latitude, longitude) with a position."""
    return (
        weather.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select(*STATION_COLUMNS)
        .distinct()
    )


def prepare_stations(station_rows: DataFrame, edge: float | None = None) -> PreparedSites:
    return prepare_sites(station_rows, "latitude", "longitude", ["station_id", "station_name"], edge)


def nearest_station(
    accidents: DataFrame, station_rows: DataFrame | PreparedSites, *, edge: float | None = None
) -> DataFrame:
    """WIN-1: one row per accident id (null is an id), of the accident's rows with a position the one
    nearest to a station, with that station (ties: station_id, name, position, accident columns).

    Output: accident columns, ``station_id, station_name, distance_to_station_m, _s_lat, _s_lon``.
    """
    acc = accidents.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    with_n = nearest(
        acc,
        station_rows,
        lat="latitude",
        lon="longitude",
        site_lat="latitude",
        site_lon="longitude",
        site_keys=["station_id", "station_name"],
        out="_n",
        edge=edge,
    )
    ranked = F.struct(
        F.col("_n.distance_m").alias("distance_to_station_m"),
        F.col("_n.station_id").alias("station_id"),
        F.col("_n.station_name").alias("station_name"),
        F.col("_n.lat").alias("_s_lat"),
        F.col("_n.lon").alias("_s_lon"),
        *[F.col(c) for c in accidents.columns if c != "accident_id"],
    )
    # A partial aggregate: repeated rows of one id meet before the shuffle.
    one = with_n.where(F.col("_n").isNotNull()).groupBy("accident_id").agg(F.min(ranked).alias("_m")).select("accident_id", "_m.*")
    return one.select(*accidents.columns, "station_id", "station_name", "distance_to_station_m", "_s_lat", "_s_lon")


def accident_weather(
    accidents: DataFrame,
    weather: DataFrame,
    *,
    tolerance_minutes: int = TOLERANCE_MINUTES,
    edge: float | None = None,
    station_rows: DataFrame | None = None,
) -> DataFrame:
    """The Gold table: 18 columns in the reference's order, one row per accident id. ``station_rows`` are the stations of
    ``weather`` where they are known already."""
    accidents = accidents.select(*ACCIDENT_COLUMNS)
    prepared = prepare_stations(stations(weather) if station_rows is None else station_rows, edge)
    year_filter = None
    if "year" in weather.columns:
        # Silver weather laid out by year= folders: skip the years outside the accidents' range.
        def year_filter(lo, hi):  # noqa: E306
            return F.col("year").cast("int").between(lo.year, hi.year)

    matched = nearest_in_time(
        nearest_station(accidents, prepared),
        weather.select("station_id", "observation_timestamp", *WEATHER_VALUES, *(["year"] if year_filter else [])),
        left_id="accident_id",
        by="station_id",
        left_ts="accident_timestamp",
        right_ts="observation_timestamp",
        right_values=WEATHER_VALUES,
        tolerance_minutes=tolerance_minutes,
        rank_prefix=["distance_to_station_m", "station_id", "station_name", "_s_lat", "_s_lon"],
        diff_col="weather_time_difference_minutes",
        ts_out="weather_timestamp",
        right_partition_filter=year_filter,
    )
    return matched.select(*GOLD_COLUMNS)


def changed_rows(previous: DataFrame | None, current_staging: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """Staging rows a merge inserts or updates: no previous row with the key, or some attribute
    ``IS DISTINCT FROM`` it. One left join of the staging rows with the previous table."""
    if previous is None:
        return current_staging
    prev = previous.select(*[F.col(c).alias(f"_p_{c}") for c in [*keys, *attrs]], F.lit(True).alias("_p"))
    cond = None
    for k in keys:
        c = current_staging[k] == prev[f"_p_{k}"]
        cond = c if cond is None else cond & c
    j = current_staging.join(prev, cond, "left")
    differs = F.lit(False)
    for a in attrs:
        differs = differs | ~F.col(a).eqNullSafe(F.col(f"_p_{a}"))
    return j.where(F.col("_p").isNull() | differs).select(*current_staging.columns)


def station_changes(previous: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """(stations that came, stations that went, their numbers) between two station sets: one aggregate over both."""
    sides = previous.select(*STATION_COLUMNS, F.lit(True).alias("_old"), F.lit(False).alias("_new"))
    sides = sides.unionByName(current.select(*STATION_COLUMNS, F.lit(False).alias("_old"), F.lit(True).alias("_new")))
    both = sides.groupBy(*STATION_COLUMNS).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    diff, n = materialize_observed(both.where("_old <> _new"), F.count_if(F.col("_new")).alias("came"), F.count_if(F.col("_old")).alias("went"), name="station_changes")
    came, went = diff.where("_new").select(*STATION_COLUMNS), diff.where("_old").select(*STATION_COLUMNS)
    return came, went, int(n["came"]), int(n["went"])


def outdated(
    previous_gold: DataFrame,
    accidents: DataFrame,
    changed_accidents: DataFrame,
    changed_weather: DataFrame,
    previous_stations: DataFrame,
    current_stations: DataFrame,
    tolerance_minutes: int = TOLERANCE_MINUTES,
) -> tuple[DataFrame, int]:
    """The accident ids (_aid) whose Gold rows may differ now, and their number: those with a changed row; those whose station
    got a changed observation within the tolerance; those whose station went; and, as a ball query, those with a new
    station at their known distance or nearer. The nearest of the few new stations is found like the nearest of all."""
    previous = previous_gold.select(F.col("accident_id").alias("_aid"), "station_id", "station_name", F.col("distance_to_station_m").alias("_known"), F.col("accident_timestamp").alias("_ats"))
    parts = [changed_accidents.select(F.col("accident_id").alias("_aid"))]
    near_obs = time_range_semi_join(
        previous.select("_aid", "station_id", "_ats"),
        changed_weather.select("station_id", F.col("observation_timestamp").alias("_ots")),
        by="station_id",
        left_ts="_ats",
        right_ts="_ots",
        tolerance_minutes=tolerance_minutes,
    )
    parts.append(near_obs.select("_aid"))
    came, went, n_came, n_went = station_changes(previous_stations, current_stations)
    if n_went:
        gone = went.select(F.col("station_id").alias("_sid"), F.col("station_name").alias("_name")).distinct()
        parts.append(previous.join(gone, F.col("station_id").eqNullSafe(F.col("_sid")) & F.col("station_name").eqNullSafe(F.col("_name")), "left_semi").select("_aid"))
    if n_came:
        reach = nearest_station(accidents.select(*ACCIDENT_COLUMNS), came).select("accident_id", "distance_to_station_m")
        ball = reach.join(previous, F.col("accident_id").eqNullSafe(F.col("_aid")), "left")
        parts.append(ball.where(F.col("_known").isNull() | (F.col("distance_to_station_m") <= F.col("_known"))).select(F.col("accident_id").alias("_aid")))
    ids, n = materialize_observed(reduce(DataFrame.unionByName, parts).distinct(), F.count(F.lit(1)).alias("n"), name="outdated")
    return ids, int(n["n"])


def refresh(
    previous_gold: DataFrame,
    accidents: DataFrame,
    weather: DataFrame,
    changed_accidents: DataFrame,
    changed_weather: DataFrame,
    previous_weather: DataFrame,
    *,
    tolerance_minutes: int = TOLERANCE_MINUTES,
) -> tuple[DataFrame, int]:
    """Incremental Gold and the number of accidents that were computed anew (``refresh_with_ids``)."""
    new, _, n = refresh_with_ids(previous_gold, accidents, weather, changed_accidents, changed_weather, previous_weather, tolerance_minutes)
    return new, n


def refresh_with_ids(
    previous_gold: DataFrame,
    accidents: DataFrame,
    weather: DataFrame,
    changed_accidents: DataFrame,
    changed_weather: DataFrame,
    previous_weather: DataFrame,
    tolerance_minutes: int = TOLERANCE_MINUTES,
) -> tuple[DataFrame, DataFrame, int]:
    """Incremental Gold, equal to ``accident_weather(accidents, weather)``, with the ids (_aid) and the number
    of accidents that were computed anew.

    A Gold row depends only on its accident rows, on the stations and on its station's observations within the
    tolerance, and merges never delete. So only the accidents that ``outdated`` names are recomputed; the other rows are
    kept. A station that came, went, moved or changed its name touches the accidents around it only.
    """
    current = materialize(stations(weather), "stations")
    ids, n = outdated(previous_gold, accidents, changed_accidents, changed_weather, stations(previous_weather), current, tolerance_minutes)
    keep = previous_gold.join(ids, previous_gold["accident_id"].eqNullSafe(ids["_aid"]), "left_anti").select(*GOLD_COLUMNS)
    if not n:
        return keep, ids, 0
    again = accidents.join(ids, accidents["accident_id"].eqNullSafe(ids["_aid"]), "left_semi")
    redo = accident_weather(again, weather, tolerance_minutes=tolerance_minutes, station_rows=current)
    return keep.unionByName(redo.select(*GOLD_COLUMNS)), ids, n
