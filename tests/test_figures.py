"""The expected figures of FIXTURES.md §5 on the sf0.01 tables."""

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def q():
    import __spark_entry__ as entry

    return entry.queries()


def test_gold_figures(spark, q):
    g = q["gold_accident_weather"](spark, SF)
    r = g.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("weather_timestamp").isNull()).alias("no_weather"),
        F.count_if(F.col("temperature").isNull()).alias("no_temp"),
        F.max("distance_to_station_m").alias("dmax"),
        F.max("weather_time_difference_minutes").alias("tmax"),
        F.count_if(F.col("station_id") == "7").alias("station7"),
    ).first()
    assert (r["n"], r["no_weather"], r["no_temp"], r["dmax"], r["tmax"], r["station7"]) == (14716, 4976, 6967, 207331.789, 119, 0)


def test_silver_figures(spark, q):
    a = q["silver_accidents"](spark, SF)
    r = a.agg(F.count(F.lit(1)), F.count_if(F.col("accident_timestamp").isNull()), F.count_if(F.col("latitude").isNull())).first()
    assert tuple(r) == (2598, 54, 93)
    assert q["silver_weather"](spark, SF).count() == 9186


def test_merge_figures(spark, q):
    a = q["merge_accidents_counts"](spark, SF).first()
    w = q["merge_weather_counts"](spark, SF).first()
    assert (a["inserted"], a["updated"], a["unchanged"], a["untouched"]) == (4000, 1121, 6879, 2000)
    assert (w["inserted"], w["updated"], w["unchanged"], w["untouched"]) == (2882, 83, 1686, 4067)
    assert [r["affected"] for r in q["merge_replay_counts"](spark, SF).collect()] == [0, 0]
