"""Session settings and lineage helpers.

The library never creates a global session itself: callers pass theirs. ``configure`` sets the
SQL options the operators rely on; ``materialize`` cuts lineage with a reliable checkpoint in the
shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SQL_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Tasks of one listing of folders: by default there is nearly one for each folder (10000 at most).
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    "spark.sql.parquet.compression.codec": "zstd",
    # Fused stages whose generated method exceeds the JVM's JIT limit (8000 bytes of bytecode)
    # would run interpreted; above this size Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "obsmatch") -> SparkSession:
    """A local session for tests, the bench and the smoke entry."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for key, value in SQL_OPTIONS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores before CPU-heavy per-row work.

    A small file is one split, so without this the per-point work of a small input runs in one
    task. Large inputs (estimated size above one split per core) are returned unchanged, so at
    scale no shuffle is added. The estimate is Catalyst's, taken without running anything.
    """
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    except Exception:  # noqa: BLE001 - no JVM handle (e.g. Spark Connect): leave the input as is
        return df
    if size >= split * par:
        return df
    # Hash of the whole row: deterministic under task retries without the sort that a
    # round-robin repartition needs for that.
    return df.repartition(par, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session; only a local session with nothing configured gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="obsmatch-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


# Open scratch scopes, per thread (streaming ``foreachBatch`` callbacks run on their own thread).
_LOCAL = threading.local()


def _scopes() -> list[str]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder (inside the current
    ``scratch_scope`` when there is one)."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/obsmatch-scratch"
    scopes = _scopes()
    if scopes:
        base = f"{base}/{scopes[-1]}"
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside the block are deleted when it ends. For jobs whose
    results are written before the block closes; lazy results must not escape it."""
    scope = f"scope-{uuid.uuid4().hex}"
    _scopes().append(scope)
    try:
        yield scope
    finally:
        _scopes().pop()
        root = f"{checkpoint_dir(spark).rstrip('/')}/obsmatch-scratch/{scope}"
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path):
            fs.delete(path, True)


def materialize_observed(df: DataFrame, *metrics: Column, name: str = "table") -> tuple[DataFrame, dict]:
    """``materialize`` that also returns aggregate ``metrics`` computed while writing, so row
    counts and bounds cost no extra pass over the data."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"obsmatch-{uuid.uuid4().hex}")
    df.observe(obs, *metrics).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), dict(obs.get)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared checkpoint folder and
    reading it back.

    One computation (``Dataset.checkpoint`` without a cache computes the plan twice), the
    result survives executor loss, and the optimizer gets the real size of the table for its
    join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
