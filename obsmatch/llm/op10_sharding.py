"""Sharding by extendible hashing, in DataFrame operations only.

The directory is indexed by leading bits of each row's hash. It starts as one bucket of no bits; a bucket
beyond the byte limit splits on its next bit, and no other does, until every bucket fits. A bucket of a
single row cannot split and may stay over the limit: a row is never cut.

The splits of one bucket are nested prefixes, so no loop over bits is needed: one small table has the bytes
of every prefix of up to ``step`` more bits, and a row's bucket is its shortest prefix that fits. Only rows
whose prefixes all overflow go to another round with longer ones.

Defined cases: null or empty text has 0 bytes; a null key hashes as its own value; repeated rows are all
placed, and their number within the group of equal rows enters the hash, so that a key or text that a third of
all rows share is still split; an empty table gives no rows. Only ``key`` and ``text`` are read, so extra
columns, also of clashing names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmatch.llm.common import materialize

#: Bytes of text that a shard may have.
SHARD_BYTES = 64 << 20
#: Bits of the hash in use: 15 hexadecimal digits of MD5.
HASH_BITS = 60
#: Buckets that a round's table may have for each limit's worth of bytes, as a power of two.
SPARE_BITS = 5


def hashed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, h) of every row, h of ``HASH_BITS`` bits."""
    parts = docs.select(F.col(key).alias("_key"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    # Equal rows meet as one row and a count (combined before the shuffle) and are numbered from it.
    counted = parts.groupBy("_key", "n_bytes").agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.select("_key", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("copy"))
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("_key").cast("string"), F.lit("null")), F.col("n_bytes").cast("string"), F.col("copy").cast("string")))
    return numbered.select("_key", "copy", "n_bytes", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("h"))


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row (key, copy, n_bytes, depth, prefix, shard) for each row of ``docs``.

    ``depth`` is the number of leading hash bits of the bucket, ``prefix`` their value, ``shard`` both as text.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    rows = materialize(hashed_rows(docs, key, text), "hashed")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    base, todo, done = 0, rows, []
    step = min(HASH_BITS, max(1, (int(total) // limit).bit_length() + SPARE_BITS))
    while True:
        top = min(HASH_BITS, base + step)
        shift = HASH_BITS - top
        leaves = todo.groupBy(F.shiftright("h", shift).alias("leaf")).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        depths = F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth")
        nested = leaves.select("leaf", "b", "n", depths).withColumn("prefix", F.expr(f"shiftright(leaf, {top} - depth)"))
        sizes = nested.groupBy("depth", "prefix").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
        fits = (F.col("b") <= limit) | (F.col("n") == 1) | (F.col("depth") == HASH_BITS)
        directory = nested.select("leaf", "depth", "prefix").join(sizes.where(fits).select("depth", "prefix"), ["depth", "prefix"])
        directory = directory.groupBy("leaf").agg(F.min("depth").alias("depth"))
        placed = materialize(todo.withColumn("leaf", F.shiftright("h", shift)).join(directory, "leaf", "left"), "placed")
        done.append(placed.where("depth is not null").withColumn("prefix", F.expr(f"shiftright(leaf, {top} - depth)")))
        todo = placed.where("depth is null").select("_key", "copy", "n_bytes", "h")
        base = top
        if base >= HASH_BITS or todo.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    shard = F.concat_ws("/", F.col("depth").cast("string"), F.col("prefix").cast("string"))
    return out.select(F.col("_key").alias(key), "copy", "n_bytes", "depth", "prefix", shard.alias("shard"))


def oracle(relation: str, limit: int) -> str:
    """DuckDB SQL for ``assign_shards`` over ``relation``: every prefix length at once."""
    return f"""
WITH counted AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes, count(*) AS n FROM {relation} GROUP BY 1, 2
), numbered AS (
  SELECT doc_id, n_bytes, unnest(range(0, n)) AS copy FROM counted
), hashed AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || n_bytes || ':' || copy), 1, 15))::BIGINT AS h FROM numbered
), nested AS (
  SELECT *, h >> ({HASH_BITS} - depth) AS prefix FROM hashed, (SELECT unnest(range(0, {HASH_BITS + 1}))::INTEGER AS depth)
), sizes AS (
  SELECT depth, prefix FROM nested GROUP BY 1, 2 HAVING sum(n_bytes) <= {limit} OR count(*) = 1 OR depth = {HASH_BITS}
), placed AS (
  SELECT doc_id, copy, n_bytes, h, min(depth) AS depth FROM nested JOIN sizes USING (depth, prefix) GROUP BY ALL
)
SELECT doc_id, copy, n_bytes, depth, h >> ({HASH_BITS} - depth) AS prefix,
       depth || '/' || (h >> ({HASH_BITS} - depth)) AS shard
FROM placed"""
