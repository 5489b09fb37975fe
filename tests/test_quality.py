import datetime as dt

from obsmatch.operators import quality
from obsmatch.schemas import GOLD_COLUMNS

SCHEMA = (
    "accident_id string, accident_timestamp timestamp_ntz, department string, city string, latitude double, "
    "longitude double, atmospheric_condition bigint, luminosity bigint, collision_type bigint, station_id string, "
    "station_name string, distance_to_station_m double, weather_timestamp timestamp_ntz, temperature double, "
    "rainfall_1h double, wind_speed double, wind_direction double, weather_time_difference_minutes bigint"
)
T = dt.datetime(2024, 1, 1, 10)


def row(i, lat=45.0, lon=1.0, ts=T, wts=T, sid="s"):
    return (i, ts, "01", "C", lat, lon, 1, 1, 1, sid, "S", 100.0, wts, 1.0, None, 2.0, 3.0, 0)


def test_bad_gold_trips_each_check(spark):
    g = spark.createDataFrame([row("dup"), row("dup"), row("lat", lat=91.0), row("lon", lon=-181.0),
                               row("ts", ts=None), row("nost", sid=None, wts=None), row("ok")], SCHEMA)
    assert g.columns == GOLD_COLUMNS
    assert [r["accident_id"] for r in quality.duplicate_accidents(g).collect()] == ["dup"]
    assert sorted(r["accident_id"] for r in quality.invalid_coordinates(g).collect()) == ["lat", "lon"]
    assert sorted(r["accident_id"] for r in quality.missing_timestamps(g).collect()) == ["nost", "ts"]
    cov = quality.matching_coverage(g).first()
    assert (cov["total_accidents"], cov["matched_accidents"], cov["unmatched_accidents"]) == (7, 6, 1)
    s = {r["check"]: (r["violations"], r["passed"]) for r in quality.summary(g).collect()}
    assert s == {"duplicate_accidents": (1, False), "invalid_coordinates": (2, False), "missing_timestamps": (2, False),
                 "matching_coverage": (None, True), "weather_completeness": (None, True)}


def test_empty_gold(spark):
    g = spark.createDataFrame([], SCHEMA)
    assert all(r["passed"] for r in quality.summary(g).collect())
    assert quality.matching_coverage(g).first()["matching_rate_pct"] is None
    assert quality.weather_completeness(g).first()["temperature_null_pct"] is None


def test_run_checks_and_profile_report(spark):
    from obsmatch.operators import profile

    g = spark.createDataFrame([row("dup"), row("dup"), row("lat", lat=91.0)], SCHEMA)
    s, results = quality.run_checks(g)
    assert [r["check"] for r in s.orderBy("pos").collect()] == [c for c, _ in quality.CHECKS]
    assert [r["accident_id"] for r in results["duplicate_accidents"].collect()] == ["dup"]
    for name in ("matching_coverage", "weather_completeness"):
        direct = quality.CHECK_FUNCTIONS[name](g)
        assert results[name].columns == direct.columns and results[name].collect() == direct.collect()
    plan = results["matching_coverage"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Join" not in plan
    raw = spark.createDataFrame([("1", "S", "45", "1", "2024010100", "", "3")], "NUM_POSTE string, NOM_USUEL string, LAT string, LON string, AAAAMMJJHH string, T string, FF string")
    rep = profile.report(raw)
    assert set(rep) == {"schema", "sample", "shape", "stations", "date_range", "non_null", "null_pct"}
    assert rep["non_null"].columns == ["FF", "T"] and tuple(rep["non_null"].first()) == (1, 0)
    assert set(profile.report(raw.select("T"))) == {"schema", "sample", "shape", "non_null", "null_pct"}
