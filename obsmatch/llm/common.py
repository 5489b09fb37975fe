"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from obsmatch.session import materialize
from obsmatch.session import configure as configure_library

__all__ = ["configure", "materialize", "settle", "slices", "table", "text_buffers", "with_arrow_columns", "string_column"]

#: Bytes of text that a task turns into numpy arrays at a time (a longer single text is taken alone).
SLICE_BYTES = 2 << 20


def configure(spark: SparkSession) -> SparkSession:
    """The library's settings, and small Arrow batches: a batch of whole texts must fit beside its arrays."""
    configure_library(spark)
    # Python workers import this package from where the driver has it, whatever folder they start in.
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def settle(spark: SparkSession) -> None:
    """Lets the driver's JVM drop the plans, generated classes and broadcasts of the jobs before, which otherwise stay until its
    heap is full; Spark's cleaner does the same every half hour (``spark.cleaner.periodicGC.interval``)."""
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (int64, from 0) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive row ranges (lo, hi) of at most ``limit`` bytes, or of one longer row, with their bytes and offsets."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def with_arrow_columns(df: DataFrame, added: str, fn: Callable[[pa.RecordBatch], list[pa.Array]], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns of the DDL string ``added``, made from each Arrow batch by ``fn``, without ``drop``.

    A column of ``df`` that has the name of an added one (in any case) is replaced by it.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(added)
    names = {f.name.lower() for f in new.fields} | {c.lower() for c in drop}
    # ``batch`` columns are taken by position, so names that differ only by case stay apart.
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    keep_at = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in names]
    schema = StructType(kept + new.fields)
    arrow_names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep_at] + fn(batch), names=arrow_names)

    return df.mapInArrow(run, schema)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int = 4 << 20) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of a partition sorted by the integer columns ``keys``, several at a time, with the row offset
    of each group. About ``limit`` bytes are taken at once, or a single larger group."""

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    held: list[pa.RecordBatch] = []
    size, next_try = 0, limit
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < next_try:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        at = starts(t)
        last = int(at[-1])
        if last:
            yield t.slice(0, last).combine_chunks(), at
            t = t.slice(last).combine_chunks()
        held = t.to_batches()
        size = t.nbytes
        next_try = max(limit, 2 * size)
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        if t.num_rows:
            yield t, np.append(starts(t), t.num_rows)
