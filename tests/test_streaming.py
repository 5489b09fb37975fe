from obsmatch.sources.sinks import VersionedTable
from obsmatch.streaming.incremental import start_merge_stream


def test_stream_merges_new_files_once(spark, tmp_root):
    schema = "k string, v double"
    src = f"{tmp_root}/silver"
    table = VersionedTable(spark, f"{tmp_root}/table")
    ck = f"{tmp_root}/ck"
    spark.createDataFrame([("a", 1.0), ("b", 2.0)], schema).write.mode("append").parquet(src)
    q = start_merge_stream(spark, src, spark.createDataFrame([], schema).schema, table, ["k"], ["v"], ck)
    q.awaitTermination()
    assert table.version() == 0
    spark.createDataFrame([("b", 3.0), ("c", 4.0)], schema).write.mode("append").parquet(src)
    q = start_merge_stream(spark, src, spark.createDataFrame([], schema).schema, table, ["k"], ["v"], ck)
    q.awaitTermination()
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
    # Nothing new: the stream merges nothing and the version stays.
    q = start_merge_stream(spark, src, spark.createDataFrame([], schema).schema, table, ["k"], ["v"], ck)
    q.awaitTermination()
    assert table.version() == 1


def test_stream_rewrites_only_the_partitions_of_a_batch(spark, tmp_root):
    schema = "k string, v double, p string"
    src, path, ck = f"{tmp_root}/silver", f"{tmp_root}/table", f"{tmp_root}/ck"
    empty = spark.createDataFrame([], schema).schema
    for rows in ([("a", 1.0, "x"), ("b", 1.0, None)], [("a", 2.0, "x"), ("c", 3.0, "x")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        q = start_merge_stream(spark, src, empty, path, ["k"], ["v"], ck, partition_cols=["p"])
        q.awaitTermination()
    assert q.last_counts[-1]["updated"] == 1
    got = sorted((tuple(r) for r in spark.read.parquet(path).select("k", "v", "p").collect()), key=repr)
    assert got == [("a", 2.0, "x"), ("b", 1.0, None), ("c", 3.0, "x")]
