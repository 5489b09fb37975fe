import datetime as dt

from obsmatch.plans import gold
from obsmatch.schemas import ACCIDENT_ATTRS, ACCIDENT_KEYS, ACCIDENTS_SCHEMA, WEATHER_ATTRS, WEATHER_KEYS, WEATHER_SCHEMA

T = dt.datetime


def a(i, h, lat=45.0, lon=1.0, atm=1):
    return (i, T(2024, 1, 1, h, 0), "01", "C", lat, lon, atm, 1, 1)


def w(sid, h, temp, lat=45.0, lon=1.0, m=0):
    return (sid, f"S{sid}", "01", T(2024, 1, 1, h, m), lat, lon, temp, None, None, None)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_refresh_equals_full_rebuild(spark):
    acc0 = [a("1", 8), a("2", 12, lon=2.0), a("3", 20, lat=46.0), a("4", 3)]
    wea0 = [w("s1", 8, 1.0), w("s1", 12, 2.0), w("s2", 12, 3.0, lon=2.0), w("s3", 20, 4.0, lat=46.0)]
    A0 = spark.createDataFrame(acc0, ACCIDENTS_SCHEMA)
    W0 = spark.createDataFrame(wea0, WEATHER_SCHEMA)
    g0 = gold.accident_weather(A0, W0)

    # Batch 2: accident 4 changes, accident 5 is new; station s2 gets a nearer observation for 2.
    stg_a = spark.createDataFrame([a("4", 8, atm=2), a("5", 12, lon=2.0)], ACCIDENTS_SCHEMA)
    stg_w = spark.createDataFrame([w("s2", 12, 9.0, lon=2.0, m=0), w("s2", 13, 5.0, lon=2.0)], WEATHER_SCHEMA)
    A1 = spark.createDataFrame([r for r in acc0 if r[0] != "4"] + [a("4", 8, atm=2), a("5", 12, lon=2.0)], ACCIDENTS_SCHEMA)
    W1 = spark.createDataFrame([r for r in wea0 if not (r[0] == "s2" and r[3].hour == 12)]
                               + [w("s2", 12, 9.0, lon=2.0), w("s2", 13, 5.0, lon=2.0)], WEATHER_SCHEMA)
    ch_a = gold.changed_rows(A0, stg_a, ACCIDENT_KEYS, ACCIDENT_ATTRS)
    ch_w = gold.changed_rows(W0, stg_w, WEATHER_KEYS, WEATHER_ATTRS)
    assert sorted(r["accident_id"] for r in ch_a.collect()) == ["4", "5"]
    assert ch_w.count() == 2
    inc, n = gold.refresh(g0, A1, W1, ch_a, ch_w, W0)
    assert n == 3  # 2 by its observation, 4 and 5 by their rows
    full = gold.accident_weather(A1, W1)
    assert rows(inc) == rows(full)
    assert [r["temperature"] for r in inc.where("accident_id = '2'").collect()] == [9.0]


def test_a_new_station_touches_the_accidents_around_it_only(spark):
    A0 = spark.createDataFrame([a("1", 8), a("2", 8, lon=9.0), a("3", 8, lat=60.0)], ACCIDENTS_SCHEMA)
    W0 = spark.createDataFrame([w("s1", 8, 1.0, lon=1.5), w("s2", 8, 2.0, lon=9.0)], WEATHER_SCHEMA)
    g0 = gold.accident_weather(A0, W0)
    W1 = W0.unionByName(spark.createDataFrame([w("s9", 9, 7.0, lon=1.0)], WEATHER_SCHEMA))
    ch_w = gold.changed_rows(W0, W1, WEATHER_KEYS, WEATHER_ATTRS)
    inc, n = gold.refresh(g0, A0, W1, A0.limit(0), ch_w, W0)
    assert rows(inc) == rows(gold.accident_weather(A0, W1))
    # Accident 3 has a long known distance, but the new station is farther still, or nearer: then it is recomputed as well.
    assert n == 2 and {r["accident_id"]: r["station_id"] for r in inc.collect()}["2"] == "s2"


def test_stations_that_move_tie_and_appear_first(spark):
    A = spark.createDataFrame([a("1", 8), a("2", 8, lon=2.0), (*a("3", 8)[:4], None, None, 1, 1, 1), a("4", 8, lon=40.0)], ACCIDENTS_SCHEMA)
    none, start = spark.createDataFrame([], WEATHER_SCHEMA), [w("s5", 8, 1.0, lon=1.5), w("s7", 8, 2.0, lon=40.0)]
    # No station before; one at the same place with a smaller id; one renamed; one moved.
    steps = [start, [*start, w("s4", 8, 5.0, lon=1.5)], [w("s4", 8, 5.0, lon=1.5), ("s5", "renamed", *start[0][2:]), start[1]], [start[0], w("s7", 8, 2.0, lon=2.0)]]
    before, g0 = none, gold.accident_weather(A, none)
    for rows_ in steps:
        now = spark.createDataFrame(rows_, WEATHER_SCHEMA)
        changed = gold.changed_rows(before, now, WEATHER_KEYS, WEATHER_ATTRS)
        inc, _ = gold.refresh(g0, A, now, A.limit(0), changed, before)
        full = gold.accident_weather(A, now)
        assert rows(inc) == rows(full)
        before, g0 = now, full
