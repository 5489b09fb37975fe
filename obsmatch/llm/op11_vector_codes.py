"""Vector code compression: product codes whose codebooks are fitted by ball k-means, in integers throughout.

A component x becomes floor(256 * x). A vector is cut into 16 equal consecutive parts, and every part position has a
codebook of 64 entries, which starts as that part of the 64 smallest ids. Each round moves every part to the nearest entry
(squared Euclidean distance, ties to the lower index) and every entry to its parts' componentwise floor(sum / count); an
entry without parts stays.

Ball k-means keeps each entry as a ball: its parts, and a radius that no part of it exceeds. Moving the entry by s makes
a radius r at most r + s, so the parts' largest distance, taken while they are assigned, bounds the next round's radius
without another pass. Only entries at most twice the radius away are a ball's neighbours. A part at distance d from its entry
can be nearer, or as near, only to entries at most 2 d away from it (triangle inequality): a part in the stable core,
nearer than half the way to the nearest neighbour, is left as it is, and one in the k-th annular ring is compared
with the k nearest neighbours only. The tests are made on whole numbers (entry distance squared <= 4 d squared, and so with
equality), so the result is that of comparing every part with every entry. In the first round all parts belong to
entry 0, whose ball is unbounded.

Spark: one row a vector; tasks assign their parts with the entries in a closure (16 * 64 parts, a size that depends on the
vectors' length only) and the rows with their codes are written to the shared folder, so a lost executor repeats its
tasks of one round. Sums, counts and largest distances are combined in every task before they are shuffled, by entry and
component, and only they come to the driver.

Defined cases: a vector that is null or has a null or non-finite component is dropped; a null id is kept, and a seed after
all others; of an id with several vectors the least one seeds; vectors shorter than the longest one, or of a length that
16 does not divide, count as filled up with zeros; x is cut to a range (2**16 and more on either side for
vectors up to 1,024 long) in which no sum of squares leaves 64 bits, and a label's error beyond them is null; a null label is a label; a vector without components has
code 00...; an empty table gives no rows; columns other than id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from obsmatch.llm.common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors that a task turns into arrays at a time have this many bytes as 64-bit integers, or are one.
BLOCK_BYTES = 8 << 20


@dataclass
class Balls:
    """The entries of all part positions, their indexes by distance from each entry, and the distances."""

    entries: np.ndarray  # (parts, entries, width) int64
    order: np.ndarray  # (parts, entries, entries - 1): the other entries, nearest first, lower index first
    gaps: np.ndarray  # (parts, entries, entries - 1): their squared distances
    neighbours: np.ndarray  # (parts, entries): how many of them are within twice the ball's radius

    @staticmethod
    def of(entries: np.ndarray, radius: np.ndarray | None = None) -> Balls:
        """``radius`` bounds the distance of an entry's parts from above; None stands for no bound."""
        parts, count, _ = entries.shape
        order = np.zeros((parts, count, count - 1), np.int64)
        gaps = np.zeros((parts, count, count - 1), np.int64)
        for p in range(parts):
            square = ((entries[p][:, None] - entries[p][None]) ** 2).sum(axis=2)
            for i in range(count):
                others = np.delete(np.arange(count), i)
                by = others[np.argsort(square[i, others], kind="stable")]
                order[p, i], gaps[p, i] = by, square[i, by]
        if radius is None:
            neighbours = np.full((parts, count), count - 1)
        else:
            # Outward rounding: an entry too many is compared for nothing, one too few would be an error.
            reach = (2 * radius * (1 + 1e-9) + 1e-6) ** 2
            neighbours = (gaps <= reach[:, :, None]).sum(axis=2)
        return Balls(entries, order, gaps, neighbours)

    def assign(self, parts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part (rows, parts, width), which is in the ball of ``own``."""
        found, least = own.astype(np.int64), np.zeros(own.shape, np.int64)
        for p in range(parts.shape[1]):
            x, at = parts[:, p], found[:, p].copy()
            near = ((x - self.entries[p, at]) ** 2).sum(axis=1)
            core = near
            best, entry = near.copy(), at.copy()
            left = np.arange(len(x))
            for ring in range(self.order.shape[2]):
                # Parts whose ring takes in this neighbour of their ball; all others are done.
                inside = (ring < self.neighbours[p, at[left]]) & (self.gaps[p, at[left], ring] <= 4 * core[left])
                left = left[inside]
                if not len(left):
                    break
                other = self.order[p, at[left], ring]
                distance = ((x[left] - self.entries[p, other]) ** 2).sum(axis=1)
                nearer = (distance < best[left]) | (distance == best[left]) & (other < entry[left])
                hit = left[nearer]
                best[hit], entry[hit] = distance[nearer], other[nearer]
            found[:, p], least[:, p] = entry, best
        return found, least


def _width(length: int, parts: int) -> int:
    return -(-length // parts)


def _limit(width: int) -> int:
    """Components beyond this are cut to it: a part's squared distance is at most 2**56, four times it and a vector's error fit."""
    return int((2.0**54 / max(1, width)) ** 0.5)


def usable(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, vector) of the rows whose vectors have finite components only."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), values.alias("vector")).where(F.col("vector").isNotNull() & finite)


def _quantised(column: pa.Array, length: int, parts: int) -> np.ndarray:
    """(rows, parts, width) integers of a list column without nulls."""
    width = _width(length, parts)
    out = np.zeros((len(column), parts * width), np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    limit = float(_limit(width))
    with np.errstate(over="ignore"):  # a huge component becomes infinite, and is cut
        out[row, at] = np.clip(np.floor(flat * SCALE), -limit, limit).astype(np.int64)
    return out.reshape(len(column), parts, width)


def _stored(parts: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(parts, "<i4")], pa.binary())


def _loaded(column: pa.Array, parts: int, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), "<i4").reshape(len(column), parts, width).astype(np.int64)


def _blocks(batch: pa.RecordBatch, width_bytes: int) -> Iterator[pa.RecordBatch]:
    step = max(1, BLOCK_BYTES // max(1, width_bytes))
    for lo in range(0, batch.num_rows, step):
        yield batch.slice(lo, step)


@dataclass
class Coded:
    """The vectors with their codes, and the codebooks they refer to."""

    rows: DataFrame  # vec_id, label, codes (a byte a part), error
    codebooks: np.ndarray  # (parts, entries, width)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> Coded:
    """Fits the codebooks on all vectors and codes all of them."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    rows = usable(vectors, key, vector, label)
    fields = rows.schema
    size = rows.agg(F.max(F.size("vector")).alias("n")).first()["n"]
    length = int(size or 0)
    width = _width(length, parts)
    kept_schema = StructType([fields["vec_id"], fields["label"]]).add("parts", "binary").add("codes", "binary")

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _blocks(whole, 8 * length):
                found = _quantised(batch.column(2), length, parts)
                codes = pa.array([bytes(parts)] * batch.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _stored(found), codes], names=kept_schema.names)

    table = materialize(rows.mapInArrow(quantise, kept_schema), "vector-parts")
    ids = [r[0] for r in rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    wanted = F.col("vec_id").isin([i for i in ids if i is not None]) | (F.col("vec_id").isNull() if None in ids else F.lit(False))
    # Of an id's vectors the least, component by component.
    found = rows.where(F.coalesce(wanted, F.lit(False))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    seeds = found.orderBy(F.col("vec_id").asc_nulls_last()).collect()
    if not seeds:
        return Coded(table.select("vec_id", "label", "codes", F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, width), np.int64))
    first = _quantised(pa.array([r["vector"] for r in seeds], pa.list_(pa.float64())), length, parts)
    codebooks = first.transpose(1, 0, 2).copy()
    radius = None
    for _ in range(rounds):
        table = materialize(_assigned(table, codebooks, radius, False), "vector-codes")
        codebooks, radius = _moved(table, codebooks)
    return Coded(_assigned(table, codebooks, radius, True), codebooks)


def _assigned(table: DataFrame, codebooks: np.ndarray, radius: np.ndarray | None, last: bool) -> DataFrame:
    """``table`` with its codes made anew; the last time without the parts, but with the error."""
    parts, _, width = codebooks.shape
    balls = Balls.of(codebooks, radius)
    kept = table.schema["vec_id"], table.schema["label"]
    schema = StructType(list(kept)).add("codes", "binary").add("error", "long") if last else table.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _blocks(whole, 8 * parts * width):
                x = _loaded(batch.column(2), parts, width)
                own = np.frombuffer(b"".join(v.as_py() for v in batch.column(3)), np.uint8).reshape(-1, parts)
                found, least = balls.assign(x, own)
                codes = pa.array([row.tobytes() for row in found.astype(np.uint8)], pa.binary())
                tail = [codes, pa.array(least.sum(axis=1))] if last else [batch.column(2), codes]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *tail], names=schema.names)

    return table.mapInArrow(run, schema)


def _moved(table: DataFrame, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries after a round, and a bound of their balls' radii around the new places."""
    parts, count, width = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * count, width + 1), np.int64)
        far = np.zeros(parts * count, np.int64)
        seen = False
        for whole in batches:
            for batch in _blocks(whole, 8 * parts * width):
                seen = True
                x = _loaded(batch.column(0), parts, width)
                own = np.frombuffer(b"".join(v.as_py() for v in batch.column(1)), np.uint8).reshape(-1, parts)
                at = (np.arange(parts) * count + own).ravel()
                flat = x.reshape(len(x) * parts, width)
                np.add.at(total, at, np.concatenate([flat, np.ones((len(flat), 1), np.int64)], axis=1))
                np.maximum.at(far, at, ((flat - codebooks.reshape(parts * count, width)[at]) ** 2).sum(axis=1))
        if seen:
            used = np.flatnonzero(total[:, width])
            place = np.repeat(used, width + 1), np.tile(np.arange(width + 1), len(used))
            columns = [place[0], place[1], total[place], np.repeat(far[used], width + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["entry", "at", "total", "far"])

    schema = StructType([StructField(n, LongType()) for n in ("entry", "at", "total", "far")])
    found = table.select("parts", "codes").mapInArrow(sums, schema).groupBy("entry", "at").agg(F.sum("total").alias("total"), F.max("far").alias("far"))
    got = found.toPandas()  # as many numbers as the codebooks have
    total, far = np.zeros((parts * count, width + 1), np.int64), np.zeros(parts * count, np.int64)
    total[got["entry"], got["at"]] = got["total"]
    far[got["entry"]] = got["far"]
    used = total[:, width] > 0
    new = codebooks.reshape(parts * count, width).copy()
    new[used] = np.floor_divide(total[used, :width], total[used, width:])
    shift = np.sqrt(((new - codebooks.reshape(parts * count, width)) ** 2).sum(axis=1).astype(np.float64))
    radius = np.sqrt(far.astype(np.float64)) + shift
    return new.reshape(codebooks.shape), radius.reshape(parts, count)


def code_vectors(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector."""
    coded = compress(vectors, **options)
    rows = materialize(coded.rows.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error"), "codes")
    by_label = rows.groupBy(F.col("label").alias("label_")).agg(F.try_sum("error").alias("label_error"))
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("label_")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(coded.sha256()).alias("codebooks_sha256"))


def oracle(table: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """All parts against all entries."""

    def assigned(k: int) -> str:
        distance = "list_sum(list_transform(range(1, len(q.x) + 1), lambda i: (q.x[i] - b.x[i]) * (q.x[i] - b.x[i])))"
        return f"a{k} AS (SELECT q.vec_id, q.part, min([{distance}, b.entry]) AS m FROM q JOIN b{k} b USING (part) GROUP BY ALL)"

    def moved(k: int) -> str:
        # Sums are whole; floor division of whole numbers, as // cuts towards zero.
        floor = "CASE WHEN s % n < 0 THEN s // n - 1 ELSE s // n END"
        return f"""
            p{k} AS (SELECT part, m[2] AS entry, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS v FROM a{k - 1} JOIN q USING (vec_id, part)),
            s{k} AS (SELECT part, entry, i, sum(v)::HUGEINT AS s, count(*)::HUGEINT AS n FROM p{k} GROUP BY ALL),
            c{k} AS (SELECT part, entry, list(({floor})::BIGINT ORDER BY i) AS x FROM s{k} GROUP BY ALL),
            b{k} AS (SELECT b.part, b.entry, coalesce(c.x, b.x) AS x FROM b{k - 1} b LEFT JOIN c{k} c USING (part, entry))"""

    steps = ", ".join(f"{assigned(k)}, {moved(k + 1)}" for k in range(rounds))
    return f"""
        WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda v: floor(v::DOUBLE * {SCALE})::BIGINT) AS x FROM {table}
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
        q AS (SELECT vec_id, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS x FROM kept, range({parts}) r(part)),
        seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}),
        b0 AS (SELECT part, entry, x FROM q JOIN seeds USING (vec_id)),
        {steps}, {assigned(rounds)},
        codes AS (SELECT vec_id, string_agg(printf('%02x', m[2]), '' ORDER BY part) AS code, sum(m[1])::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
        books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM codes JOIN kept USING (vec_id), books
    """
