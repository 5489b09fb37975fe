from obsmatch.session import materialize, scratch_path, scratch_scope, spread
from obsmatch.sources.delimited import read_delimited, write_delimited


def test_spread_small_input_uses_all_cores(spark):
    small = materialize(spark.range(1000).selectExpr("id", "id * 2 AS v").coalesce(1))
    out = spread(small)
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in out.collect()) == list(range(1000))


def test_gzip_files_are_spread_after_the_scan(spark, tmp_root):
    df = spark.range(200).selectExpr("cast(id AS string) AS k", "'x' AS v").coalesce(1)
    write_delimited(df, tmp_root, compression="gzip")
    out = read_delimited(spark, tmp_root, min_partitions=4)
    assert out.rdd.getNumPartitions() == 4 and out.count() == 200


def test_scratch_scope_removes_its_tables(spark):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    with scratch_scope(spark):
        path = scratch_path(spark, "t")
        spark.range(3).write.parquet(path)
        p = jvm.org.apache.hadoop.fs.Path(path)
        assert p.getFileSystem(conf).exists(p)
    assert not p.getFileSystem(conf).exists(p)
