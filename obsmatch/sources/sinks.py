"""Sinks (SNK-1..5): partitioned Parquet and versioned tables.

Plain Parquet tables reject MERGE, UPDATE and CREATE OR REPLACE, and a plan may not overwrite
the path it reads. A ``VersionedTable`` therefore writes every new state to a fresh folder of its own, ``_new=<id>``, and
publishes it by renaming that folder to ``_v=<base + 1>``, where ``base`` is the version the writer read. Only one folder can
get that name, so of two writers that read the same version one succeeds and the other gets ``Conflict`` and plans its
work again on the newer version: no update is lost (optimistic concurrency). The current version is the highest one: there
is no pointer to replace or to lose, and a folder that a dead job left behind is never read. Renaming a folder must be one
step, as on HDFS and local file systems; task retries inside a write are handled by Spark's commit protocol.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# In a version's folder: what it was published with; that its rows were deleted since.
PUBLISHED, EMPTIED = "_PUBLISHED", "_EMPTIED"


class Conflict(RuntimeError):
    """Another writer published a version after the one that this writer read."""


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    *,
    mode: str = "overwrite",
    sort_within: Sequence[str] = (),
    dynamic: bool = False,
    observe: tuple[Observation, list[Column]] | None = None,
) -> None:
    """SNK-1: zstd Parquet, one folder per partition value. With ``dynamic`` only the partitions
    present in ``df`` are replaced, otherwise the whole path is.

    Rows are dealt out by the partition columns with a rebalance, so that adaptive execution splits
    a large partition into several tasks and files. ``sort_within`` clusters rows inside each file
    (the reference sorts before writing; a global order is not observable downstream, so no range
    shuffle is paid for it). ``observe`` counts above that exchange: there a retried shuffle does
    not count twice, and an empty input still reports.
    """
    out = df
    if partition_cols:
        out = out.hint("rebalance", *[F.col(c) for c in partition_cols])
    if sort_within:
        out = out.sortWithinPartitions(*partition_cols, *sort_within)
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    writer = out.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def partition_id(columns: Sequence[str]) -> Column:
    """The partition values of a row as one text; nulls are values of their own."""
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in columns])


def ensure_namespaces(spark: SparkSession, names: Sequence[str]) -> None:
    """SNK-5: create each database (namespace) if absent."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


class _FS:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.jvm = jvm
        self.path = jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(conf)

    def child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def exists(self, name: str) -> bool:
        return bool(self.fs.exists(self.child(name)))

    def names(self) -> list[str]:
        if not self.fs.exists(self.path):
            return []
        return [status.getPath().getName() for status in self.fs.listStatus(self.path)]

    def read_text(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self.fs.open(self.child(name))
        try:
            reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return (reader.readLine() or "").strip()
        finally:
            stream.close()

    def create(self, name: str, text: str = "") -> bool:
        """Creates a file with one line; False if it is there already."""
        from py4j.protocol import Py4JJavaError

        try:
            out = self.fs.create(self.child(name), False)
        except Py4JJavaError as e:
            if self.exists(name):
                return False
            raise e
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return True


    def rename(self, source: str, target: str) -> None:
        self.fs.rename(self.child(source), self.child(target))

    def delete(self, name: str) -> None:
        self.fs.delete(self.child(name), True)


class VersionedTable:
    """A table whose state is replaced by publishing a new version (SNK-2..4, UPS-4)."""

    def __init__(self, spark: SparkSession, root: str, partition_cols: Sequence[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_cols = list(partition_cols)
        self._fs = _FS(spark, self.root)

    def versions(self) -> list[int]:
        """The versions that can be read, oldest first."""
        found = sorted(int(n[3:]) for n in self._fs.names() if n.startswith("_v=") and n[3:].isdigit())
        return [n for n in found if not self._fs.exists(f"_v={n}/{EMPTIED}")]

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def exists(self) -> bool:
        return self.version() is not None

    def path(self, version: int | None = None) -> str:
        v = self.version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no version of {self.root}")
        return f"{self.root}/_v={v}"

    def read(self, version: int | None = None) -> DataFrame:
        from obsmatch.operators.upsert import CHANGE

        return self.spark.read.parquet(self.path(version)).drop(CHANGE)

    def changes(self, after: int, upto: int) -> DataFrame | None:
        """The rows that the merges ``after`` + 1 to ``upto`` inserted or updated, each as that merge left it; None if
        a version among them is gone or was not made by a merge."""
        from obsmatch.operators.upsert import CHANGE

        here = set(self.versions())
        parts = [self.spark.read.parquet(self.path(n)) for n in range(after + 1, upto + 1) if n in here]
        if not parts or len(parts) < upto - after or any(CHANGE not in p.columns for p in parts):
            return None
        return reduce(DataFrame.unionByName, [p.where(F.col(CHANGE).isin("insert", "update")).drop(CHANGE) for p in parts])

    def sources(self, version: int | None = None) -> dict | None:
        """What a version (the current one) was published with: the versions it was built from."""
        v = self.version() if version is None else version
        text = None if v is None else self._fs.read_text(f"_v={v}/{PUBLISHED}")
        return json.loads(text)["sources"] if text else None

    def stage(self) -> str:
        """The name of a folder that nobody else writes and nobody reads."""
        return f"_new={uuid.uuid4().hex}"

    def publish(self, staged: str, base: int | None, sources: dict | None = None) -> int:
        """Makes the folder ``staged`` the version after ``base`` (None: the first). ``Conflict`` if there is one already."""
        n = 0 if base is None else base + 1
        self._fs.create(f"{staged}/{PUBLISHED}", json.dumps({"staged": staged, "sources": sources or {}}))
        if not self._fs.exists(f"_v={n}"):
            self._fs.rename(staged, f"_v={n}")
        text = self._fs.read_text(f"_v={n}/{PUBLISHED}")
        if text is None or json.loads(text)["staged"] != staged:
            # A rename onto a folder that came first puts this one inside it, under a name that readers skip.
            self._fs.delete(f"_v={n}/{staged}")
            self._fs.delete(staged)
            raise Conflict(f"version {n} of {self.root} was published by another writer")
        return n

    def replace(self, df: DataFrame, sources: dict | None = None, base: int | None = -1) -> int:
        """SNK-4: write ``df`` as the next version, then publish it. With ``base`` (None: no version) only if that is still the
        current one; without it ``df`` follows whatever is current then."""
        staged = self.stage()
        write_partitioned(df, f"{self.root}/{staged}", self.partition_cols)
        if base != -1:
            return self.publish(staged, base, sources)
        while True:
            try:
                return self.publish(staged, self.version(), sources)
            except Conflict:  # its folder is gone
                staged = self.stage()
                write_partitioned(df, f"{self.root}/{staged}", self.partition_cols)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes the rows of all versions but the last ``keep``. Their names stay taken, so that a slow writer still meets
        its conflict."""
        for n in self.versions()[:-keep]:
            self._fs.create(f"_v={n}/{EMPTIED}")
            folder = _FS(self.spark, f"{self.root}/_v={n}")
            for name in folder.names():
                if name not in (PUBLISHED, EMPTIED):
                    folder.delete(name)


def merge_into(
    table: VersionedTable,
    staging: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
) -> dict[str, int]:
    """UPS-4 end to end: initialise from staging or merge into the current version.

    Staging is written once (SNK-2). One join of it with the target gives the next state and what happened to each of its
    rows; both are written together, and counted by that write, into a folder that becomes the next version if a
    row was inserted or updated (a replay publishes nothing) and if nobody else published one meanwhile: else the merge is
    planned again on the version that is current then. Every conflict means that another merge succeeded. Returns the
    counts.
    """
    from obsmatch.operators.upsert import CHANGE, change_counts, changes, plan
    from obsmatch.session import materialize, scratch_scope

    with scratch_scope(table.spark):
        staging = materialize(staging, "staging")
        while True:
            base = table.version()
            if base is None:
                state = staging.withColumn(CHANGE, F.lit("insert"))
            else:
                target = table.read(base)
                state = changes(plan(target, staging, keys, attrs), target.columns)
            staged, seen = table.stage(), Observation(f"merge-{uuid.uuid4().hex}")
            write_partitioned(state, f"{table.root}/{staged}", table.partition_cols, observe=(seen, change_counts(keys)))
            found = {k: int(v) for k, v in seen.get.items()}
            if base is not None and not found["affected"]:
                table._fs.delete(staged)
                return found
            try:
                table.publish(staged, base)
                return found
            except Conflict:
                continue


def merge_partitions(
    spark: SparkSession,
    path: str,
    staging: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    partition_cols: Sequence[str],
) -> dict[str, int]:
    """Keyed upsert into a partitioned Parquet table that reads and rewrites only the partitions
    present in ``staging`` (SURVEY §4.4).

    Exact when every key determines its partition (weather: the month of the observation hour;
    accidents: a hash bucket of the id), since a staging row can then only match target rows of
    its own partition. The target scan is pruned to the touched partition values, null among them, by
    one filter on the partition columns; the merged partitions are written once to the shared
    checkpoint folder (a plan may not overwrite what it reads), and then swapped in with Spark's
    dynamic partition overwrite. Nothing is written when nothing changes. A failure before
    the final commit leaves the table as it was; as the merge is idempotent, re-running the same
    load repairs a failure during it.
    """
    from obsmatch.operators.upsert import counts, next_state, plan, upsert
    from obsmatch.session import materialize, scratch_path, scratch_scope

    parts = list(partition_cols)
    fs = _FS(spark, path)
    with scratch_scope(spark):
        staging = materialize(staging, "staging")
        if not any(n[:1] not in "_." for n in fs.names()):  # no table, or a first load that committed nothing
            _, found = upsert(None, staging, keys, attrs)
            write_partitioned(staging, path, parts)
            return {k: int(v) for k, v in found.first().asDict().items()}

        target = spark.read.parquet(path)
        staging = staging.select(*target.columns)
        # One value a folder that the load touches: no more than the file listing holds for them.
        touched = [r[0] for r in staging.select(partition_id(parts)).distinct().collect()]
        target = target.where(partition_id(parts).isin(touched)).select(*staging.columns)
        planned = plan(target, staging, keys, attrs)
        found = {k: int(v) for k, v in counts(planned, keys).first().asDict().items()}
        if found["affected"] > 0:
            merged = scratch_path(spark, "merged_partitions")
            next_state(planned, staging.columns).write.mode("overwrite").parquet(merged)
            write_partitioned(spark.read.parquet(merged), path, parts, dynamic=True)
    return found
