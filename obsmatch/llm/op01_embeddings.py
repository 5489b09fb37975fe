"""Near-duplicate embeddings by lattice hashing: every pair of one label with cosine >= 0.98, counted and linked.

Unit vectors are turned by one random rotation and cut into blocks of 8 coordinates: orthogonal random projections,
one hash table each. Two unit vectors with cosine c lie sqrt(2 - 2c) apart, and the squared distances in the blocks
add up, so in at least one of T tables they are within r = sqrt((2 - 2c) / T). In each table a vector is entered in
its own E8 cell and in the neighbouring cells that come within r / 2 of it: the midpoint of such a pair lies within
r / 2 of both, so its cell holds both. No pair is missed, up to rounding, for which there are margins.

A cell's vectors are compared by one matrix product. Cells with many entries are split into chunks that meet two by
two, so no task holds a whole hot cell. A pair may meet in several cells; it counts only in the cell of the
midpoint of the first table that brings it within r. Tasks give out sums of links and spanning trees, never all
pairs. Equal vectors of a label are one entry with a multiplicity from the start.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components, and any with a null
label, links with nothing; vectors of different lengths never link; rows of one vec_id share its result; a row
with a null vec_id, alone in its class, has a null component and is kept; an empty table gives no rows; only the
three columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmatch.llm.common import groups, materialize
from obsmatch.llm.components import components
from obsmatch.llm.e8 import cells_within, decode
from obsmatch.llm.words import mix

COSINE = 0.98
#: r / 2 in lattice units: it sets the lattice's scale. Larger cells are fewer entries and more comparisons.
RADIUS = 0.177
SEED = 11
#: Entries of a cell that are compared at once.
CHUNK = 512
#: Bytes of vectors in one batch of entries, far below what 32-bit offsets reach.
BATCH_BYTES = 32 << 20


@lru_cache(maxsize=8)
def rotation(size: int, seed: int) -> np.ndarray:
    """A random rotation of ``size`` coordinates, padded to whole blocks of 8."""
    tables = -(-size // 8)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(8 * tables, 8 * tables)))
    return q[:size]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision. Sums go column by column, so that a row's bits never depend on its batch."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * x[:, k]
    return x / np.sqrt(total)[:, None]


def project(x: np.ndarray, seed: int) -> np.ndarray:
    turn = rotation(x.shape[1], seed)
    out = np.zeros((len(x), turn.shape[1]))
    for k in range(x.shape[1]):
        out += x[:, k : k + 1] * turn[k]
    return out


def cell_key(table: np.ndarray | int, point: np.ndarray) -> np.ndarray:
    acc = np.broadcast_to(np.asarray(table, np.int64), len(point)).astype(np.uint64)
    for k in range(8):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + np.rint(2 * point[:, k]).astype(np.int64).view(np.uint64))
    return acc.view(np.int64)


def unit_of(tables: int, cosine: float, radius: float) -> float:
    """The distance in a block that is one lattice unit."""
    return float(np.sqrt((2 - 2 * cosine) / tables)) / 2 / radius


def entries(x: np.ndarray, cosine: float, radius: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every entry of the unit vectors ``x``."""
    p = project(x, seed)
    tables = p.shape[1] // 8
    scale = unit_of(tables, cosine, radius)
    rows, cells = [], []
    for t in range(tables):
        row, point = cells_within(p[:, 8 * t : 8 * t + 8] / scale, radius)
        rows.append(row)
        cells.append(cell_key(t, point))
    return np.concatenate(rows), np.concatenate(cells)


def meeting_cell(pa_: np.ndarray, pb: np.ndarray, cosine: float, radius: float) -> np.ndarray:
    """The one cell in which a pair of projected vectors counts."""
    tables = pa_.shape[1] // 8
    limit = (2 - 2 * cosine) / tables * (1 + 1e-9)
    scale = unit_of(tables, cosine, radius)
    first = np.full(len(pa_), -1)
    for t in range(tables - 1, -1, -1):
        d = np.zeros(len(pa_))
        for k in range(8 * t, 8 * t + 8):
            d += (pa_[:, k] - pb[:, k]) ** 2
        first[d <= limit] = t
    out = np.zeros(len(pa_), np.int64)
    for t in range(tables):
        at = np.flatnonzero(first == t)
        if len(at):
            middle = (pa_[at, 8 * t : 8 * t + 8] + pb[at, 8 * t : 8 * t + 8]) / 2
            out[at] = cell_key(t, decode(middle / scale))
    return out


def _vectors(column: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(dtype).reshape(len(column), -1)


def near_embeddings(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", embedding: str = "embedding", label: str = "label", radius: float = RADIUS, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    wide = "double" in dict(vectors.select(F.col(embedding).alias("e")).dtypes)["e"]
    dtype = np.float64 if wide else np.float32
    rows = vectors.select(F.col(key).alias("id"), F.col(embedding).alias("e"), F.col(label).alias("l"))
    finite = F.forall("e", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.withColumn("e", F.when(F.col("l").isNotNull() & finite & F.exists("e", lambda x: x != 0), F.col("e")))
    reps = rows.where("e is not null").groupBy("l", "e").agg(F.min("id").alias("rid"), F.count(F.lit(1)).alias("mult"))
    reps = materialize(reps, "vectors")

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(rid, size, cell) entries with the vectors' bytes; vectors of one length at a time."""
        for batch in batches:
            e = batch.column(batch.schema.get_field_index("e"))
            sizes = np.diff(e.offsets.to_numpy())
            flat = e.flatten().to_numpy()
            begin = np.concatenate([[0], np.cumsum(sizes)])
            for size in np.unique(sizes):
                for at in np.array_split(np.flatnonzero(sizes == size), max(1, int((sizes == size).sum()) // 500)):
                    x = flat[(begin[at][:, None] + np.arange(size)).ravel()].reshape(len(at), size)
                    row, cell = entries(unit(x), cosine, radius, seed)
                    per = max(1, BATCH_BYTES // (size * x.itemsize))
                    for lo in range(0, len(row), per):  # a long vector has many entries
                        part = row[lo : lo + per]
                        body = np.ascontiguousarray(x[part]).view(np.uint8).ravel()
                        offsets = np.arange(len(part) + 1, dtype=np.int32) * np.int32(size * x.itemsize)
                        raw = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
                        own = pa.array(at[part])
                        kept = [batch.column(batch.schema.get_field_index(c)).take(own) for c in ("l", "rid", "mult")]
                        columns = [*kept, pa.array(np.full(len(part), size, np.int64)), pa.array(cell[lo : lo + per]), raw]
                        yield pa.RecordBatch.from_arrays(columns, names=["l", "rid", "mult", "size", "cell", "v"])

    kind = dict(reps.dtypes)
    found = reps.mapInArrow(cells_of, f"l {kind['l']}, rid {kind['rid']}, mult bigint, size bigint, cell bigint, v binary")
    # A clash of this hash only adds candidates: lengths, labels and cells are compared again.
    group = F.xxhash64("l", "size", "cell").alias("g")
    hot = found.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
    hot = hot.select(F.col("g").alias("hot_g"), F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    hot = materialize(hot, "hot")
    found = found.select("*", group)
    found = found.join(hot, found["g"] == hot["hot_g"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    found = found.withColumn("own", F.pmod(F.xxhash64("rid", "l"), F.col("chunks")).cast("int"))
    found = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    found = found.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    label_id = F.xxhash64("l").alias("label")
    found = found.select("g", "i", "j", "own", label_id, "rid", "mult", "size", "cell", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in groups(batches, ["g", "i", "j"], 8 << 20):
            rid, mult, own, cell, lab, size = (t.column(c).to_numpy() for c in ("rid", "mult", "own", "cell", "label", "size"))
            first, last = t.column("i").to_numpy(), t.column("j").to_numpy()
            for width in np.unique(size):
                yield from _compare(np.flatnonzero(size == width), at, t.column("v"), rid, mult, own, cell, lab, first, last, dtype, cosine, radius, seed)

    keys = ["g", "i", "j"]
    linked = found.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a bigint, b bigint, n bigint")
    linked = materialize(linked, "linked")
    sums = linked.groupBy("a").agg(F.sum("n").alias("n"))
    comp = components(linked.where("b is not null"))
    out = rows.join(reps.withColumnRenamed("l", "l2").withColumnRenamed("e", "e2"), (F.col("l") == F.col("l2")) & (F.col("e") == F.col("e2")), "left")
    out = out.select("id", F.coalesce("rid", "id").alias("rid"), F.coalesce("mult", F.lit(1)).alias("mult"), F.col("rid").alias("found"))
    out = out.join(sums, F.col("found") == F.col("a"), "left").join(comp, F.col("found") == F.col("node"), "left")
    component = F.coalesce("component", "rid")
    return out.select(
        F.col("id").alias(key),
        (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _compare(
    use: np.ndarray, at: np.ndarray, column: pa.ChunkedArray, rid: np.ndarray, mult: np.ndarray, own: np.ndarray, cell: np.ndarray,
    lab: np.ndarray, first: np.ndarray, last: np.ndarray, dtype: type, cosine: float, radius: float, seed: int,
) -> Iterator[pa.RecordBatch]:
    """Sums of links and spanning trees of the pairs that count in the groups of one vector length.

    ``use`` has the rows of that length, ``at`` the offsets of the groups; the other arrays are by row."""
    raw = _vectors(column.combine_chunks().take(pa.array(use)), dtype)
    x = unit(raw)
    group = np.searchsorted(at, use, "right") - 1
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    left, right = [], []
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if hi - lo < 2:
            continue
        head = use[lo]
        if first[head] == last[head]:
            near = x[lo:hi] @ x[lo:hi].T >= cosine - 1e-9
            a, b = np.nonzero(np.triu(near, 1))
        else:
            p = np.flatnonzero(own[use[lo:hi]] == first[head])
            q = np.flatnonzero(own[use[lo:hi]] == last[head])
            a, b = np.nonzero(x[lo + p] @ x[lo + q].T >= cosine - 1e-9)
            a, b = p[a], q[b]
        left.append(a + lo)
        right.append(b + lo)
    if not left:
        return
    a, b = np.concatenate(left), np.concatenate(right)
    keep = []
    for lo in range(0, len(a), 1 << 16):  # bounded arrays, however dense a cell is
        i, j = a[lo : lo + (1 << 16)], b[lo : lo + (1 << 16)]
        ok = (lab[use[i]] == lab[use[j]]) & (rid[use[i]] != rid[use[j]]) & (np.einsum("ij,ij->i", x[i], x[j]) >= cosine)
        i, j = i[ok], j[ok]
        if len(i):
            some, back = np.unique(np.concatenate([i, j]), return_inverse=True)
            p = project(x[some], seed)
            ok = meeting_cell(p[back[: len(i)]], p[back[len(i) :]], cosine, radius) == cell[use[i]]
            keep.append((i[ok], j[ok]))
    if not keep:
        return
    a, b = np.concatenate([k[0] for k in keep]), np.concatenate([k[1] for k in keep])
    if not len(a):
        return
    ids, back = np.unique(rid[use[np.concatenate([a, b])]], return_inverse=True)
    a_at, b_at = back[: len(a)], back[len(a) :]
    n = np.zeros(len(ids), np.int64)
    np.add.at(n, a_at, mult[use[b]])
    np.add.at(n, b_at, mult[use[a]])
    low = np.arange(len(ids))
    while True:  # smallest id by links, within this task
        new = low.copy()
        np.minimum.at(new, a_at, low[b_at])
        np.minimum.at(new, b_at, low[a_at])
        new = new[new]
        if (new == low).all():
            break
        low = new
    root = ids[low]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(root, mask=root == ids), pa.array(n)], names=["a", "b", "n"])


def oracle(relation: str, cosine: float = COSINE) -> str:
    """DuckDB SQL: every pair of a label, and reachability step by step."""
    return f"""
WITH RECURSIVE checked AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding,
    label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in embedding if x <> 0]) > 0 AS ok
  FROM {relation}
), v AS (SELECT r, vec_id, CASE WHEN ok THEN label END AS label, [coalesce(x, 0)::DOUBLE for x in embedding] AS e FROM checked),
links AS (
  SELECT a.r, a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= {cosine}
), pairs AS (SELECT DISTINCT a, b FROM links),
reach AS (SELECT a AS x, a AS y FROM pairs UNION SELECT x, b FROM reach JOIN pairs ON a = y),
low AS (SELECT x, min(y) AS c FROM reach GROUP BY 1),
counts AS (SELECT r, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) IS NOT DISTINCT FROM vec_id AS kept
FROM v LEFT JOIN counts USING (r) LEFT JOIN low ON x = vec_id"""
