import datetime as dt

from obsmatch.plans.gold import accident_weather
from obsmatch.schemas import ACCIDENTS_SCHEMA, GOLD_COLUMNS, WEATHER_SCHEMA

T = dt.datetime


def acc(spark, rows):
    return spark.createDataFrame(rows, ACCIDENTS_SCHEMA)


def wea(spark, rows):
    return spark.createDataFrame(rows, WEATHER_SCHEMA)


def a(i, ts, lat=45.0, lon=1.0):
    return (i, ts, "01", "C", lat, lon, 1, 1, 1)


def w(sid, ts, temp, lat=45.0, lon=1.0):
    return (sid, f"S{sid}", "01", ts, lat, lon, temp, None, None, None)


def test_time_ties_edges_and_missing(spark):
    accidents = acc(spark, [
        a("tie", T(2024, 1, 1, 10, 30)),
        a("edge", T(2024, 1, 2, 10, 0)),
        a("late", T(2024, 1, 3, 10, 0)),
        a("nots", None),
        a("nopos", T(2024, 1, 1, 10, 0), lat=None),
    ])
    weather = wea(spark, [
        w("s", T(2024, 1, 1, 10, 0), 1.0), w("s", T(2024, 1, 1, 11, 0), 2.0),
        w("s", T(2024, 1, 2, 12, 0), 3.0),
        w("s", T(2024, 1, 3, 12, 0, 1), 4.0),
    ])
    g = accident_weather(accidents, weather)
    assert g.columns == GOLD_COLUMNS
    got = {r["accident_id"]: (r["station_id"], r["weather_timestamp"], r["weather_time_difference_minutes"]) for r in g.collect()}
    assert got == {
        "tie": ("s", T(2024, 1, 1, 10, 0), 30),
        "edge": ("s", T(2024, 1, 2, 12, 0), 120),
        "late": ("s", None, None),
        "nots": ("s", None, None),
    }


def test_no_stations_gives_no_rows(spark):
    g = accident_weather(acc(spark, [a("x", T(2024, 1, 1))]), wea(spark, []))
    assert g.count() == 0


def test_nearest_station_without_data_keeps_station(spark):
    accidents = acc(spark, [a("x", T(2024, 1, 1, 10, 0), lat=45.0, lon=1.0)])
    weather = wea(spark, [w("near", T(2023, 1, 1, 10, 0), 1.0, lon=1.01), w("far", T(2024, 1, 1, 10, 0), 2.0, lon=2.0)])
    r = accident_weather(accidents, weather).first()
    assert (r["station_id"], r["weather_timestamp"]) == ("near", None)


def test_duplicate_ids_collapse(spark):
    accidents = acc(spark, [a("d", T(2024, 1, 1, 10, 0), lon=1.5), a("d", T(2024, 1, 1, 10, 0), lon=1.0)])
    weather = wea(spark, [w("s", T(2024, 1, 1, 10, 0), 1.0)])
    rows = accident_weather(accidents, weather).collect()
    assert len(rows) == 1 and rows[0]["longitude"] == 1.0


def test_year_partitions_of_weather_are_pruned(spark, tmp_root):
    from obsmatch.operators import asof

    weather = wea(spark, [w("s", T(2023, 6, 1, 10, 0), 5.0), w("s", T(2024, 1, 1, 10, 0), 1.0)])
    from pyspark.sql import functions as F

    weather.withColumn("year", F.year("observation_timestamp").cast("string")).write.partitionBy("year").parquet(tmp_root)
    stored = spark.read.parquet(tmp_root)
    seen = []
    real = asof.neighbours

    def spy(left, right, *args):
        seen.append(right._jdf.queryExecution().executedPlan().toString())
        return real(left, right, *args)

    asof.neighbours = spy
    try:
        g = accident_weather(acc(spark, [a("x", T(2024, 1, 1, 10, 30))]), stored)
        r = g.first()
    finally:
        asof.neighbours = real
    assert (r["weather_timestamp"], r["temperature"]) == (T(2024, 1, 1, 10, 0), 1.0)
    scans = [line for line in seen[0].split("\n") if "FileScan" in line and "PartitionFilters" in line]
    assert any("year" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_candidates_compute_times_once_per_row_not_per_pair(spark):
    from obsmatch.plans.queries_gold import _candidates

    at = dt.datetime(1969, 12, 31, 23, 59, 30)
    acc = [("1", at, 45.0, 1.0), ("1", at, 45.5, 1.0), (None, at + dt.timedelta(seconds=45), 45.0, 1.0), ("2", None, 45.0, 1.0)]
    a = spark.createDataFrame(acc, "accident_id string, accident_timestamp timestamp_ntz, latitude double, longitude double")
    secs = [-7201, -7200, -7199, -60, -59, 0, 59, 60, 7199, 7200, 7201]
    obs = [("s", "S", at + dt.timedelta(seconds=s), 45.0, 1.0, float(s)) for s in secs]
    w = spark.createDataFrame(obs, "station_id string, station_name string, observation_timestamp timestamp_ntz, latitude double, longitude double, temperature double")
    got = _candidates(a, w)
    want = []
    for key, ts in (("1", at), (None, at + dt.timedelta(seconds=45))):
        gaps = [(o[2] - ts, o) for o in obs if abs(o[2] - ts) <= dt.timedelta(hours=2)]
        want += [(key, "s", o[2], int(gap.total_seconds() / 60), o[5]) for gap, o in gaps]
    want.append(("2", "s", None, None, None))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "timestampdiff" not in plan[: plan.index("Join")].lower()
