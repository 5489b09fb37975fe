"""Delimited raw files (SRC-1..3): ``;``-separated with a header, optionally compressed.

Every column is read as a string (no inference), so leading zeros survive (SURVEY Q6) and
the Silver jobs do all typing with safe casts. Spark's CSV reader applies the first file's
header to every file by position; files whose headers differ are therefore read in separate
groups and unioned by name.

The headers come from a Spark job over the list of files: each task opens its files and reads
up to the first line that is not blank, which is the line Spark takes as a header. The driver
sees the distinct headers, and file names only where there are several of them.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.session import materialize_observed, scratch_path

#: Scheme names of Hadoop that the file systems of Arrow call otherwise.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfss": "abfss"}
#: Compressions in which Hadoop frames blocks in a way of its own; such files are opened by Hadoop.
HADOOP_ONLY = (".deflate", ".snappy", ".lz4", ".lzo")
HEADERS = "path string, header string, opened boolean"
#: Folders that one task of ``write_delimited`` writes, about; each costs milliseconds, however little is in it.
FOLDERS_PER_TASK = 500
#: Folders that one job of ``write_delimited`` writes, about; the driver keeps kilobytes for each until the job is committed.
FOLDERS_PER_JOB = 20_000


def arrow_file(path: str) -> tuple[pafs.FileSystem, str] | None:
    """The file system and the name in it of a Hadoop path; None if Arrow has none for its scheme."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme not in ARROW_SCHEMES:
        return None
    authority, _, name = rest.removeprefix("//").partition("/")
    system, root = pafs.FileSystem.from_uri(f"{ARROW_SCHEMES[scheme]}://{authority}")
    return system, f"{root.rstrip('/')}/{name}"


def _first_filled(lines: Iterator[str]) -> str | None:
    return next((line.rstrip("\r\n") for line in lines if line.strip("\ufeff \t\r\n")), None)


def _header(path: str) -> tuple[str | None, bool]:
    """(header line, None in a file of blank lines; whether the file could be opened in a task)."""
    found = None if path.endswith(HADOOP_ONLY) else arrow_file(path)
    if found is None:
        return None, False
    with found[0].open_input_stream(found[1], compression="detect", buffer_size=1 << 16) as stream:
        line = _first_filled(io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline=None))
    return (None if line is None else line.removeprefix("\ufeff")), True


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        read = [_header(p) for p in paths]
        columns = [paths, [h for h, _ in read], [o for _, o in read]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.bool_()), strict=True)], ["path", "header", "opened"])


def _hadoop_header(spark: SparkSession, path: str) -> str | None:
    """The header line of a file that only Hadoop can open, read on the driver."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    stream = p.getFileSystem(conf).open(p)
    try:
        source = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8"))
        line = _first_filled(iter(reader.readLine, None))
        return None if line is None else line.removeprefix("\ufeff")
    finally:
        stream.close()


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, int]:
    """One row (path, header) for each data file under ``paths`` (folders are listed recursively by Spark's file
    index, contents are not read by it), written once, and the number of gzip files. A file of blank lines has a null header;
    files without a byte are not listed, and where there are no others, ``FileNotFoundError`` says so."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([paths] if isinstance(paths, str) else list(paths))
    found, n = materialize_observed(
        listed.select("path").mapInArrow(_headers, HEADERS),
        F.count(F.lit(1)).alias("files"),
        F.count_if(~F.col("opened")).alias("left"),
        F.count_if(F.col("path").endswith(".gz")).alias("gzip"),
        name="headers",
    )
    if not n["files"]:
        raise FileNotFoundError(f"no file with content under {paths}")
    out = found.where("opened").select("path", "header")
    if n["left"]:
        rest = [(r["path"], _hadoop_header(spark, r["path"])) for r in found.where("not opened").toLocalIterator()]
        out = out.unionByName(spark.createDataFrame(rest, "path string, header string"))
    return out, int(n["gzip"])


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    sep: str = ";",
    base_path: str | None = None,
    with_file: bool = False,
    min_partitions: int | None = None,
) -> DataFrame:
    """SRC-1/2: all-string DataFrame of the delimited files; compressed files are decoded.

    ``base_path`` turns ``key=value`` folders below it into string columns. ``with_file`` adds
    ``source_file``. Gzip files are one split each; ``min_partitions`` spreads them afterwards.
    Files of blank lines only have no header and no rows; if there are no others, there are no columns either.
    """
    files, gzip = file_headers(spark, paths)
    headers = sorted(r["header"] for r in files.where("header is not null").select("header").distinct().collect())
    frames = []
    for header in headers:
        reader = spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
        if len(headers) == 1 and not base_path:
            df = reader.option("recursiveFileLookup", True).csv([paths] if isinstance(paths, str) else list(paths))
        else:
            if base_path:
                reader = reader.option("basePath", base_path)
            same = files.where(F.col("header") == header).select("path")
            df = reader.csv(sorted(r["path"] for r in same.toLocalIterator()))
        if with_file:
            df = df.withColumn("source_file", F.col("_metadata.file_path"))
        frames.append(df)
    if not frames:
        return spark.createDataFrame([], "struct<>")
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    if min_partitions and gzip:
        out = out.repartition(min_partitions)
    return out


def write_delimited(df: DataFrame, path: str, *, sep: str = ";", compression: str | None = None,
                    partition_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write a raw-shaped table as delimited text with a header (for landing and tests).

    With ``partition_cols`` one file lands in each folder. Where there are many folders, the tasks are as many as these need:
    adaptive execution would merge them by their bytes, and small objects would be written one by one in one task. Beyond
    ``FOLDERS_PER_JOB`` the rows are dealt out by their folder and land in several jobs, so that the driver holds one job's folders only.
    """
    w = df.write.mode(mode).option("header", True).option("sep", sep)
    if compression:
        w = w.option("compression", compression)
    if partition_cols:
        folders = df.select(F.approx_count_distinct(F.xxhash64(*partition_cols))).first()[0]
        # "ignore" decides once whether anything is written.
        jobs = 1 if mode == "ignore" else max(1, math.ceil(folders / FOLDERS_PER_JOB))
        tasks = math.ceil(folders / jobs / FOLDERS_PER_TASK)
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        for part in [df] if jobs == 1 else _dealt(df, partition_cols, jobs):
            spread = part.repartition(max(tasks, least), *partition_cols) if tasks > 1 else part.repartition(*partition_cols)
            spread.write.mode(mode).option("header", True).option("sep", sep).option(
                "compression", compression or "none"
            ).partitionBy(*partition_cols).csv(path)
            mode = "append"
        return
    w.csv(path)


def _dealt(df: DataFrame, partition_cols: Sequence[str], jobs: int) -> list[DataFrame]:
    """``df``, written once, in ``jobs`` parts by the hash of its folders."""
    dealt = scratch_path(df.sparkSession, "landing")
    job = F.pmod(F.xxhash64(*partition_cols), F.lit(jobs)).cast("int")
    df.withColumn("_landing_job", job).write.partitionBy("_landing_job").parquet(dealt)
    rows = df.sparkSession.read.parquet(dealt)
    return [rows.where(F.col("_landing_job").cast("int") == i).drop("_landing_job") for i in range(jobs)]
