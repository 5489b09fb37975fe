"""The state of the quality checks equals the checks on the whole of Gold, after every refresh."""

import datetime as dt

from pyspark.sql import functions as F

from obsmatch.operators import quality, quality_state
from obsmatch.plans import jobs
from obsmatch.schemas import ACCIDENTS_SCHEMA, WEATHER_SCHEMA
from obsmatch.sources.sinks import VersionedTable

GOLD = (
    "accident_id string, latitude double, longitude double, accident_timestamp timestamp, weather_timestamp timestamp, station_id string, "
    "distance_to_station_m double, weather_time_difference_minutes bigint, temperature double, rainfall_1h double, wind_speed double, "
    "wind_direction double, bucket int, n int"
)
T = dt.datetime(2024, 1, 1)


def g(i, lat=45.0, d=10.5, m=30, temp=1.0, when=T):
    return (i, lat, 1.0, T, when, None if d is None else "s", d, m, temp, None, 2.0, None, 9, 9)


def equal(gold, state):
    for name in ("matching_coverage", "weather_completeness"):
        a, b = getattr(quality, name)(gold), getattr(quality_state, name)(state)
        assert a.columns == b.columns and a.dtypes == b.dtypes
        assert a.collect() == b.collect()
    assert quality.summary(gold).collect() == quality_state.summary(state).collect()


def test_three_refreshes_equal_full_scans(spark):
    now = [g(str(k), d=k * 1.25, m=k) for k in range(40)] + [g(None), g(None, lat=91.0)]
    gold = spark.createDataFrame(now, GOLD)
    state = quality_state.partials(gold, 16)
    equal(gold, state)
    steps = [
        # A repeated id with a bad place; the greatest distance goes; the null ids go.
        ([r for r in now if r[0]] + [g("7", lat=None)], ["7", None]),
        ([r for r in now if r[0] not in ("39", "38", None)] + [g("7", lat=None)], ["39", "38"]),
        ([g("7", temp=None, when=None)], [str(k) for k in range(40)]),
    ]
    for rows, ids in steps:
        gold = spark.createDataFrame(rows, GOLD)
        state = quality_state.refresh(state, gold, spark.createDataFrame([(i,) for i in ids], "accident_id string"), buckets=16)
        equal(gold, state)
    assert state.count() == 1  # buckets without rows are gone


def test_only_touched_buckets_are_counted_again(spark):
    gold = spark.createDataFrame([g(str(k)) for k in range(50)], GOLD)
    stale = quality_state.partials(gold, 8).withColumn("matched", F.lit(1000).cast("bigint"))
    after = quality_state.refresh(stale, gold, spark.createDataFrame([("3",)], "accident_id string"), buckets=8)
    assert after.where("matched <> 1000").count() == 1 and after.count() == 8


def test_empty_gold(spark):
    gold = spark.createDataFrame([], GOLD)
    equal(gold, quality_state.partials(gold))
    none = quality_state.refresh(quality_state.partials(gold), gold, gold.select("accident_id"))
    equal(gold, none)


def test_a_job_keeps_the_state_with_gold(spark, tmp_path):
    def acc(i, h, lon=1.0):
        return (i, T.replace(hour=h), "01", "C", 45.0, lon, 1, 1, 1)

    def wea(h, temp):
        return ("s1", "S1", "01", T.replace(hour=h), 45.0, 1.0, temp, None, None, None)

    paths = [f"{tmp_path}/{n}" for n in ("a", "w", "g")]
    state = VersionedTable(spark, f"{tmp_path}/m")

    def load(a, w):
        out = jobs.load_and_build_gold(
            spark, spark.createDataFrame(a, ACCIDENTS_SCHEMA), spark.createDataFrame(w, WEATHER_SCHEMA), *paths, metrics_table=f"{tmp_path}/m"
        )
        equal(VersionedTable(spark, paths[2]).read(), state.read())
        return out["metrics"]

    first = [acc(str(k), k % 20) for k in range(30)]
    assert load(first, [wea(8, 1.0)]) == "rebuilt"
    assert load(first, [wea(8, 1.0)]) == "unchanged"
    assert load([acc("3", 8), acc("99", 12, 2.0)], [wea(12, None)]) == "refreshed"
    # A run without the state leaves it behind; the next one counts everything.
    jobs.load_and_build_gold(spark, spark.createDataFrame([acc("100", 8)], ACCIDENTS_SCHEMA), spark.createDataFrame([wea(12, 4.0)], WEATHER_SCHEMA), *paths)
    assert load(first[:1], [wea(12, 4.0)]) == "rebuilt"
