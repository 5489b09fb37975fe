"""Landed-file layout (SRC-4..6): ``key=value`` folders, one-object guards, lineage.

Folders are listed in tasks, level by level, with partition values read as strings, so ``department=01`` stays ``'01'``:
Spark's file index would keep every folder and file on the driver. It lists (``binaryFile`` without reading the content) only
where Arrow cannot open the file system.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.functions.expr import url_filename
from obsmatch.session import materialize_observed
from obsmatch.sources.delimited import arrow_file

LISTED = "path string, size_bytes long, base string, keys array<string>, parts array<string>"
#: Folders that one task lists, about, and rows of one batch of the list.
FOLDERS_PER_TASK, BATCH_ROWS = 1_000, 10_000
#: What Spark writes for null as a partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _unescaped(name: str) -> str:
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


def _partition(folder: str) -> tuple[str, list[str], list[str | None]]:
    """(what lies before them, keys, values) of the ``key=value`` folders in a folder's path below the root: the last ones that
    follow one another, as Spark's file index takes them."""
    names = [n for n in folder.split("/") if n]
    while names and "=" not in names[-1]:
        names.pop()
    first = len(names)
    while first and "=" in names[first - 1]:
        first -= 1
    found = [n.partition("=") for n in names[first:]]
    return "/".join(names[:first]), [_unescaped(k) for k, _, _ in found], [None if v == NULL_FOLDER else _unescaped(v) for _, _, v in found]


def _children(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists folders below ``root``: one row for each file, and for each folder one without a size."""
    schema = pa.schema([("path", pa.string()), ("size_bytes", pa.int64()), ("base", pa.string()), ("keys", pa.list_(pa.string())), ("parts", pa.list_(pa.string()))])

    def listed(folder: str) -> Iterator[tuple]:
        system, name = arrow_file(folder)
        base, keys, parts = _partition(folder[len(root):])
        for info in system.get_file_info(pafs.FileSelector(name)):
            n = info.base_name
            # Names that Spark does not read either.
            if n.startswith(".") or n.endswith("._COPYING_") or (n.startswith("_") and "=" not in n):
                continue
            if info.type == pafs.FileType.Directory:
                yield f"{folder}/{n}", None, None, None, None
            else:
                yield f"{folder}/{n}", info.size, base, keys, parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for row in listed(folder):
                    rows.append(row)
                    if len(rows) == BATCH_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _is_folder(path: str) -> bool:
    """Whether ``path`` is a folder that tasks can list."""
    try:
        found = arrow_file(path)
        return found is not None and found[0].get_file_info(found[1]).type == pafs.FileType.Directory
    except (OSError, pa.ArrowException):
        return False


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """SRC-4: one row per file with content under ``root``: path, name, size and the partition columns.

    Each level of folders is one job whose list is written; the driver sees the number of its folders and the partition columns.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    top = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    if not _is_folder(top):
        return _indexed_files(spark, root)
    level, folders, found = spark.createDataFrame([(top,)], "path string"), 1, []
    while folders:
        tasks = min(folders, max(spark.sparkContext.defaultParallelism, math.ceil(folders / FOLDERS_PER_TASK)))
        listed, m = materialize_observed(
            level.repartition(tasks).mapInArrow(_children(top), LISTED),
            F.count_if(F.col("size_bytes").isNull()).alias("folders"),
            F.count_if(F.col("size_bytes") > 0).alias("files"),
            name="listed",
        )
        if m["files"] or not found:
            found.append(listed.where("size_bytes > 0"))
        level, folders = listed.where("size_bytes is null").select("path"), m["folders"]
    files = reduce(DataFrame.unionByName, found)
    shapes = files.where("size(keys) > 0").select("base", "keys").distinct().limit(2).collect()
    if len(shapes) > 1:
        raise ValueError(f"folders under {root} differ in their partition columns: {shapes}")
    keys = shapes[0]["keys"] if shapes else []
    return (files.where("size(keys) > 0") if keys else files).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "size_bytes",
        *[F.col("parts")[i].alias(k) for i, k in enumerate(keys)],
    )


def _indexed_files(spark: SparkSession, root: str) -> DataFrame:
    """``landed_files`` by Spark's file index, which keeps the list on the driver."""
    df = spark.read.format("binaryFile").option("basePath", root).load(root)
    parts = [c for c in df.columns if c not in ("path", "modificationTime", "length", "content")]
    return df.select(
        F.col("path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        *parts,
    )


def file_counts(
    files: DataFrame,
    partition_cols: Sequence[str],
    *,
    strict: bool = False,
    expected: DataFrame | None = None,
) -> DataFrame:
    """SRC-5: distinct files per partition. ``expected`` lists the requested partitions, so that
    a request with no object reports 0; ``strict`` raises unless every count is exactly one (Q17)."""
    out = files.groupBy(*partition_cols).agg(F.countDistinct("path").alias("files"))
    if expected is not None:
        out = expected.select(*partition_cols).join(out, list(partition_cols), "left").select(
            *partition_cols, F.coalesce("files", F.lit(0)).alias("files")
        )
    if strict:
        out = out.withColumn(
            "files",
            F.when(F.col("files") != 1, F.raise_error(F.lit("expected exactly one object per partition"))).otherwise(
                F.col("files")
            ),
        )
    return out


class NotOneObject(ValueError):
    """A partition that was asked for has no file, or several."""


def require_one(counts: DataFrame) -> None:
    """SRC-5 as a check before a job: raises ``NotOneObject`` with the partitions of ``file_counts`` whose number is not one
    (the first twenty by value)."""
    keys = [c for c in counts.columns if c != "files"]
    bad = counts.where("files <> 1").orderBy(*keys).limit(20).collect()
    if bad:
        told = "; ".join(f"{', '.join(f'{k}={r[k]}' for k in keys)}: {r['files']}" for r in bad)
        raise NotOneObject(f"one file is expected in each, found {told}")


def lineage(files: DataFrame, catalog: DataFrame, file_key: str = "file_name", keys: Sequence[str] = ()) -> DataFrame:
    """SRC-6: each landed file with the catalog resource (url, title) that it came from.

    A resource is known by the file name in its URL and by ``keys``, the partition values that files and
    catalog share: two resources of one file name in different folders keep their own url and title.
    """
    cat = catalog.select("id", "title", "url", url_filename("url").alias("_fname"), *[F.col(k).cast("string").alias(f"_k_{k}") for k in keys])
    same = files[file_key] == cat["_fname"]
    for k in keys:
        same = same & files[k].cast("string").eqNullSafe(cat[f"_k_{k}"])
    return files.join(cat.where(F.col("_fname").isNotNull()), same, "left").drop("_fname", *[f"_k_{k}" for k in keys])
