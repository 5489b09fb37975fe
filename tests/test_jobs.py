import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest

from obsmatch.operators import quality
from obsmatch.plans import jobs
from obsmatch.sources.delimited import write_delimited
from obsmatch.sources.layout import NotOneObject

ACC = "Num_Acc string, jour string, mois string, an string, hrmn string, lum string, dep string, com string, atm string, col string, lat string, long string"
WEA = "NUM_POSTE string, NOM_USUEL string, LAT string, LON string, AAAAMMJJHH string, T string, RR1 string, FF string, DD string, department string"


def test_raw_to_gold_and_replay(spark, tmp_root):
    acc_rows = [
        ("1", "5", "1", "2024", "9:05", "1", "01", "C1", "2", "3", "45,000", " 1,000"),
        ("2", "5", "1", "2024", "2400", "1", "01", "C1", "x", "3", "45,100", "1,100"),
        ("3", "5", "1", "2024", "1000", "1", "2A", "C2", "2", "3", "42,000", "9,000"),
    ]
    wea_rows = [
        ("00000001", "S1", "45.01", "1.01", "2024010509", "3.5", "", "4", "90", "01"),
        ("00000001", "S1", "45.01", "1.01", "2024010510", "3.9", "0.2", None, "90", "01"),
        ("00000002", "S2", "44.0", "2.0", "2023010509", "1.0", "", "", "", "02"),
    ]
    write_delimited(spark.createDataFrame(acc_rows, ACC), f"{tmp_root}/raw/acc")
    write_delimited(spark.createDataFrame(wea_rows, WEA), f"{tmp_root}/raw/wea", partition_cols=["department"])
    a = jobs.build_silver_accidents(spark, f"{tmp_root}/raw/acc", f"{tmp_root}/silver/acc", 2024, ["1"])
    w = jobs.build_silver_weather(spark, f"{tmp_root}/raw/wea", f"{tmp_root}/silver/wea", [2024])
    assert (a["silver_rows"], w["silver_rows"]) == (2, 2)
    sa = spark.read.parquet(f"{tmp_root}/silver/acc")
    sw = spark.read.parquet(f"{tmp_root}/silver/wea")
    assert {r["department"] for r in sw.collect()} == {"01"}
    out = jobs.load_and_build_gold(spark, sa, sw, f"{tmp_root}/t/acc", f"{tmp_root}/t/wea", f"{tmp_root}/gold")
    gold = spark.read.parquet(f"{tmp_root}/gold/_v={out['gold_version']}")
    got = {r["accident_id"]: (r["station_id"], r["weather_timestamp"], r["weather_time_difference_minutes"]) for r in gold.collect()}
    assert got == {"1": ("00000001", dt.datetime(2024, 1, 5, 9, 0), 5), "2": ("00000001", None, None)}
    summary = {r["check"]: r["violations"] for r in quality.summary(gold).collect()}
    assert summary["missing_timestamps"] == 1 and summary["duplicate_accidents"] == 0
    replay = jobs.load_and_build_gold(spark, sa, sw, f"{tmp_root}/t/acc", f"{tmp_root}/t/wea", f"{tmp_root}/gold")
    assert replay["accidents"]["affected"] == 0 and replay["weather"]["affected"] == 0
    assert replay["gold"] == "unchanged" and replay["gold_version"] == out["gold_version"]
    # A second batch: a new observation near accident 2's hour makes the refresh recompute it.
    extra = spark.createDataFrame([("00000001", "S1", "01", dt.datetime(2024, 1, 5, 1, 0), 45.01, 1.01, 7.0, None, None, None)],
                                  "station_id string, station_name string, department string, observation_timestamp timestamp_ntz, "
                                  "latitude double, longitude double, temperature double, rainfall_1h double, wind_speed double, wind_direction double")
    inc = jobs.load_and_build_gold(spark, sa, extra, f"{tmp_root}/t/acc", f"{tmp_root}/t/wea", f"{tmp_root}/gold")
    assert inc["gold"] == "refreshed" and inc["weather"]["inserted"] == 1
    from obsmatch.plans import gold as G
    from obsmatch.sources.sinks import VersionedTable
    g_inc = VersionedTable(spark, f"{tmp_root}/gold").read()
    g_full = G.accident_weather(VersionedTable(spark, f"{tmp_root}/t/acc").read(), VersionedTable(spark, f"{tmp_root}/t/wea").read())
    assert sorted(tuple(r) for r in g_inc.collect()) == sorted(tuple(r) for r in g_full.collect())


def _weather_rows(departments):
    # Hours and stations in falling order: only the job's own order can be rising.
    return [(f"{d}{s:06d}", "S", "45.0", "1.0", f"20240105{h:02d}", "1.0", "", "", "", d) for d in departments for h in (9, 3, 21, 0) for s in (3, 1, 2)]


def _files(root):
    return sorted(glob.glob(f"{root}/year=*/department=*/*.parquet"))


def test_rows_are_in_order_within_files(spark, tmp_path):
    acc = [(str(k), str(28 - k), "1", "2024", f"{k:02d}05", "1", d, "C", "2", "3", "45,0", "1,0") for d in ("01", "2A") for k in range(20)]
    write_delimited(spark.createDataFrame(acc, ACC).repartition(3), f"{tmp_path}/raw/acc")
    write_delimited(spark.createDataFrame(_weather_rows(["01", "02"]), WEA), f"{tmp_path}/raw/wea", partition_cols=["department"])
    jobs.build_silver_accidents(spark, f"{tmp_path}/raw/acc", f"{tmp_path}/acc", 2024)
    jobs.build_silver_weather(spark, f"{tmp_path}/raw/wea", f"{tmp_path}/wea", 2024)
    for root, columns, files, total in ((f"{tmp_path}/acc", ["accident_timestamp"], 2, 40), (f"{tmp_path}/wea", ["station_id", "observation_timestamp"], 2, 24)):
        tables = [pq.ParquetFile(f).read(columns=columns).to_pylist() for f in _files(root)]
        assert len(tables) >= files and sum(map(len, tables)) == total
        for rows in tables:
            found = [tuple(r[c] for c in columns) for r in rows]
            assert found == sorted(found)


def test_weather_of_chosen_departments(spark, tmp_path, monkeypatch):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    write_delimited(spark.createDataFrame(_weather_rows(["01", "02", "2A"]), WEA), raw, partition_cols=["department"])
    jobs.build_silver_weather(spark, raw, out, 2024)
    before = {f: os.stat(f).st_mtime_ns for f in _files(out) if "department=02" in f}
    # Chosen: 1 (written as 01) and one without a folder. The folder of 02 is not read, its files stay.
    (tmp_path / "raw/department=02/broken.csv").write_bytes(b"other;columns\n1;2\n")
    got = jobs.build_silver_weather(spark, raw, out, 2024, ["1", "2B"])
    assert got == {"bronze_rows": 12, "silver_rows": 12}
    assert before and before == {f: os.stat(f).st_mtime_ns for f in _files(out) if "department=02" in f}
    assert {r["department"] for r in spark.read.parquet(out).select("department").distinct().collect()} == {"01", "02", "2A"}
    with pytest.raises(FileNotFoundError, match="2B"):
        jobs.build_silver_weather(spark, raw, out, 2024, "2B")


def test_strict_jobs_want_one_file(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    write_delimited(spark.createDataFrame(_weather_rows(["01", "02"]), WEA), raw, partition_cols=["department"])
    assert jobs.build_silver_weather(spark, raw, f"{tmp_path}/out", 2024, strict=True)["silver_rows"] == 24
    with pytest.raises(NotOneObject, match="department=03: 0"):
        jobs.build_silver_weather(spark, raw, f"{tmp_path}/none", 2024, ["01", "03"], strict=True)
    write_delimited(spark.createDataFrame(_weather_rows(["02"]), WEA), raw, partition_cols=["department"], mode="append")
    assert jobs.build_silver_weather(spark, raw, f"{tmp_path}/out", 2024, "01", strict=True)["silver_rows"] == 12
    with pytest.raises(NotOneObject, match="department=02: 2"):
        jobs.build_silver_weather(spark, raw, f"{tmp_path}/none", 2024, strict=True)
    acc = [("1", "5", "1", "2024", "9:05", "1", "01", "C1", "2", "3", "45,0", "1,0")]
    write_delimited(spark.createDataFrame(acc, ACC).coalesce(1), f"{tmp_path}/a1")
    write_delimited(spark.createDataFrame(acc * 2, ACC).repartition(2, "Num_Acc"), f"{tmp_path}/a2")
    write_delimited(spark.createDataFrame(acc, ACC).coalesce(1), f"{tmp_path}/a2", mode="append")
    assert jobs.build_silver_accidents(spark, {2024: f"{tmp_path}/a1"}, f"{tmp_path}/acc", strict=True)["silver_rows"] == 1
    with pytest.raises(NotOneObject, match="year=2025: 2"):
        jobs.build_silver_accidents(spark, {2024: f"{tmp_path}/a1", 2025: f"{tmp_path}/a2"}, f"{tmp_path}/none", strict=True)
    assert not os.path.exists(f"{tmp_path}/none")
