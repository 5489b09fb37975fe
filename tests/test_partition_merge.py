import datetime as dt

from pyspark.sql import functions as F

from obsmatch.sources.sinks import merge_partitions

SCHEMA = "station_id string, observation_timestamp timestamp_ntz, temperature double"


def with_month(df):
    return df.withColumn("month", F.date_format("observation_timestamp", "yyyy-MM"))


def test_only_touched_partitions_are_rewritten(spark, tmp_root):
    T = dt.datetime
    first = with_month(spark.createDataFrame(
        [("1", T(2024, 1, 5, 10), 1.0), ("1", T(2024, 2, 5, 10), 2.0), ("2", T(2024, 3, 5, 10), 3.0)], SCHEMA))
    keys, attrs = ["station_id", "observation_timestamp"], ["temperature", "month"]
    c0 = merge_partitions(spark, tmp_root, first, keys, attrs, ["month"])
    assert c0["inserted"] == 3
    files_before = {p for p in spark.read.parquet(tmp_root).inputFiles() if "month=2024-01" in p or "month=2024-03" in p}
    second = with_month(spark.createDataFrame([("1", T(2024, 2, 5, 10), 2.5), ("3", T(2024, 2, 6, 0), 4.0)], SCHEMA))
    c1 = merge_partitions(spark, tmp_root, second, keys, attrs, ["month"])
    assert (c1["inserted"], c1["updated"], c1["unchanged"], c1["untouched"]) == (1, 1, 0, 0)
    out = spark.read.parquet(tmp_root)
    files_after = {p for p in out.inputFiles() if "month=2024-01" in p or "month=2024-03" in p}
    assert files_after == files_before
    got = sorted((r["station_id"], r["temperature"]) for r in out.collect())
    assert got == [("1", 1.0), ("1", 2.5), ("2", 3.0), ("3", 4.0)]
    c2 = merge_partitions(spark, tmp_root, second, keys, attrs, ["month"])
    assert c2["affected"] == 0


def test_target_scan_is_pruned(spark, tmp_root):
    from obsmatch.operators import upsert

    T = dt.datetime
    rows = [("1", T(2024, m, 5, 10), float(m)) for m in range(1, 13)]
    keys, attrs = ["station_id", "observation_timestamp"], ["temperature", "month"]
    merge_partitions(spark, tmp_root, with_month(spark.createDataFrame(rows, SCHEMA)), keys, attrs, ["month"])
    plans = []
    real_plan = upsert.plan

    def spy(target, staging, k, a):
        plans.append(target._jdf.queryExecution().executedPlan().toString())
        return real_plan(target, staging, k, a)

    upsert.plan = spy
    try:
        stg = with_month(spark.createDataFrame([("1", T(2024, 3, 5, 10), 30.0)], SCHEMA))
        c = merge_partitions(spark, tmp_root, stg, keys, attrs, ["month"])
    finally:
        upsert.plan = real_plan
    assert c["updated"] == 1
    scan = [line for line in plans[0].split("\n") if "FileScan" in line][0]
    assert "PartitionFilters: [" in scan and "2024-03" in scan.split("PartitionFilters: [")[1]
