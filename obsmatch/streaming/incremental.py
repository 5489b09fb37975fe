"""Incremental load driven by arriving Silver files (the reference's staging + MERGE step).

The reference loads one Silver file into a staging table and merges it. Here a Structured
Streaming file source picks up new Silver Parquet files and ``foreachBatch`` merges each
micro-batch into a table with the same keyed, change-detecting upsert: a ``VersionedTable``, or a
partitioned Parquet table of which only the partitions in the batch are read and rewritten. The stream
checkpoint (in the shared folder) records which files were merged, and the merge itself is
idempotent for non-null keys, so a batch replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from obsmatch.sources.sinks import VersionedTable, merge_into, merge_partitions


def start_merge_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    table: VersionedTable | str,
    keys: Sequence[str],
    attrs: Sequence[str],
    checkpoint: str,
    *,
    partition_cols: Sequence[str] = (),
    available_now: bool = True,
) -> StreamingQuery:
    """Merge every new Parquet file under ``source_dir`` into ``table``: a versioned table, or the path of a
    table partitioned by ``partition_cols``, which every key must determine.

    ``available_now`` processes what is there and stops (a scheduled batch run); otherwise the
    query keeps running. The merge counts of the last batch are kept on the returned query's
    ``last_counts`` attribute for inspection.
    """
    stream = spark.readStream.schema(schema).parquet(source_dir)
    results: list[dict[str, int]] = []

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if isinstance(table, str):
            results.append(merge_partitions(batch.sparkSession, table, batch, keys, attrs, partition_cols))
        else:
            results.append(merge_into(table, batch, keys, attrs))

    writer = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    query.last_counts = results  # type: ignore[attr-defined]
    return query
