"""Line dedup with two Bloom filters: only suspected repeats leave the task that read them.

A text's lines end at ``\\n``; a line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
lower-cased. A document is a row of the table. Steps:

1. Every task keeps two Bloom filters of its lines: *once* (keys met) and *twice* (keys met in a second document). Filters
   merge as ``once = a | b`` and ``twice = ta | tb | (a & b)``, in any order and without losing a repeat: a key met by two
   tasks has its bits in both *once* filters. They travel in segments of 16 KiB, are merged in tasks (first by a salt, then
   whole), and have 8 bits for every line of the corpus, 2**28 bits (32 MiB, the only thing broadcast here besides 2.) at
   most. Beyond 33 million lines the share of keys passed on for nothing grows; no repeat is ever missed.
2. Keys in the merged *twice* filter are the suspects. Only they are shuffled, as 128-bit fingerprints (xxHash3), combined
   before the shuffle, and counted exactly; those of ``min_docs`` documents or more are confirmed. The chance that any two of
   10**12 keys share a fingerprint is about 10**-15.
3. Lines of confirmed keys go, in every document (``keep="none"``) or in all but the first occurrence by (key column, line
   number) (``keep="first"``). Where the confirmed fingerprints take no more than ``BROADCAST_BYTES`` (measured when they are
   written) and no occurrence is kept, tasks drop the lines as they read; otherwise the suspects are joined with them, and
   each document with the numbers of its lines to drop, both by shuffles that adaptive execution splits. Both ways give the
   same rows.

Defined cases: null text has one empty line and stays null; an empty text has one empty line; keys of fewer than
``min_chars`` code points are never dropped; a line repeated within one document counts it once; repeated rows are documents of
their own; with ``keep="first"`` a null id comes first, and rows equal in id and text are treated alike; a text of any
length is read in pieces of about a megabyte; an empty table gives no rows; columns named as an added one (n_lines,
n_dropped) are replaced by it, all others are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from obsmatch.llm.common import materialize, string_column, text_buffers, with_arrow_columns
from obsmatch.session import materialize_observed

MIN_DOCS = 10
MIN_CHARS = 1
SPACE = b" \t\n\x0b\x0c\r"
#: Bits of a filter for each line, most bits of a filter, bits that a key sets.
LINE_BITS, MAX_BITS, PROBES = 8, 1 << 28, 4
SEGMENT_WORDS = 2048
SALTS = 32
BROADCAST_BYTES = 16 << 20
#: Bytes of a text that are split into lines at a time (a longer line is taken whole).
PIECE = 1 << 20


def lines_of(raw: bytes) -> Iterator[list[bytes]]:
    """The lines of a text, some at a time."""
    at = 0
    while True:
        cut = raw.find(b"\n", at + PIECE) if at + PIECE < len(raw) else -1
        yield raw[at : cut if cut >= 0 else len(raw)].split(b"\n")
        if cut < 0:
            return
        at = cut + 1


def keys_of(lines: list[bytes], min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The fingerprint of each line's key; None where the key is too short."""
    keys = [line.strip(SPACE).lower() for line in lines]  # bytes: only A-Z
    if min_chars <= 1:
        return [xxh3_128_digest(k) if k or min_chars < 1 else None for k in keys]
    return [xxh3_128_digest(k) if len(k) >= min_chars and len(k.decode("utf-8", "replace")) >= min_chars else None for k in keys]


def _raw_rows(column: pa.Array) -> Iterator[bytes]:
    data, at = text_buffers(column)
    view = memoryview(np.ascontiguousarray(data))
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield bytes(view[lo:hi])


def _pairs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


class Filter:
    """A Bloom filter over 128-bit fingerprints, a power of two of bits in 64-bit words."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def _bits(self, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(PROBES):
            place = (pairs[:, 0] + np.uint64(k) * pairs[:, 1]) & self.mask
            yield (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))

    def add(self, pairs: np.ndarray) -> None:
        for word, bit in self._bits(pairs):
            np.bitwise_or.at(self.words, word, bit)

    def has(self, pairs: np.ndarray) -> np.ndarray:
        out = np.ones(len(pairs), bool)
        for word, bit in self._bits(pairs):
            out &= (self.words[word] & bit) != 0
        return out


def count_lines(docs: DataFrame, text: str) -> int:
    breaks = F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    return int(docs.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1).alias("n")).first()["n"] or 0)


def filter_words(lines: int) -> int:
    bits = 64 * SEGMENT_WORDS
    while bits < min(MAX_BITS, LINE_BITS * lines):
        bits *= 2
    return bits // 64


def _batch_keys(column: pa.Array, min_chars: int) -> Iterator[list[bytes]]:
    """The distinct keys of each row, of many rows at a time."""
    held: list[bytes] = []
    for raw in _raw_rows(column):
        row: set[bytes | None] = set()
        for part in lines_of(raw):
            row.update(keys_of(part, min_chars))
        row.discard(None)
        held.extend(row)
        if len(held) >= 1 << 16:
            yield held
            held = []
    if held:
        yield held


def repeat_filter(docs: DataFrame, text: str, lines: int, min_chars: int = MIN_CHARS) -> Filter:
    """The *twice* filter of all rows."""
    words = filter_words(lines)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = twice = None
        for batch in batches:
            for digests in _batch_keys(batch.column(0), min_chars):
                if once is None:
                    once, twice = Filter(np.zeros(words, np.uint64)), Filter(np.zeros(words, np.uint64))
                pairs, count = np.unique(_pairs(digests), axis=0, return_counts=True)
                known = once.has(pairs)
                twice.add(pairs[known | (count > 1)])
                once.add(pairs[~known])
        if once is not None:
            for k in range(words // SEGMENT_WORDS):
                part = slice(k * SEGMENT_WORDS, (k + 1) * SEGMENT_WORDS)
                if once.words[part].any():
                    yield _segment(k, once.words[part], twice.words[part])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None
        for batch in batches:
            for k, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if k != at:
                    if at is not None:
                        yield _segment(at, once, twice)
                    at, once, twice = k, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if at is not None:
            yield _segment(at, once, twice)

    schema = "seg int, once binary, twice binary"
    parts = docs.select(F.col(text).alias("text")).mapInArrow(build, schema)
    # A segment of all tasks is first merged in SALTS places.
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = salted.repartition("seg", "salt").drop("salt").sortWithinPartitions("seg").mapInArrow(merge, schema)
    whole = some.repartition("seg").sortWithinPartitions("seg").mapInArrow(merge, schema)
    out = np.zeros(words, np.uint64)
    for r in whole.select("seg", "twice").toLocalIterator():  # MAX_BITS in all
        out[r["seg"] * SEGMENT_WORDS : (r["seg"] + 1) * SEGMENT_WORDS] = np.frombuffer(r["twice"], np.uint64)
    return Filter(out)


def _segment(k: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([once.tobytes()], pa.binary()), pa.array([twice.tobytes()], pa.binary())], names=["seg", "once", "twice"])


def suspect_counts(docs: DataFrame, text: str, seen: Filter, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, n): the suspected keys with their numbers of documents, exact."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digests in _batch_keys(batch.column(0), min_chars):
                pairs = _pairs(digests)
                pairs, n = np.unique(pairs[seen.has(pairs)], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64)), pa.array(n, pa.int64())], names=["a", "b", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "a bigint, b bigint, n bigint")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def suspect_lines(docs: DataFrame, key: str, text: str, seen: Filter, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, rid, id, line, fresh): every suspected line; ``fresh`` marks a key's first line in its document, ``rid`` is
    the document's fingerprint (see ``_with_rid``)."""
    rows = _with_rid(docs, key, text).select("_rid", F.col(key).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, raw in enumerate(_raw_rows(batch.column(2))):
                number, met = 0, set()
                for part in lines_of(raw):
                    keys = keys_of(part, min_chars)
                    lines = [j for j, d in enumerate(keys) if d is not None]
                    digests = [keys[j] for j in lines]
                    if digests:
                        pairs = _pairs(digests)
                        keep = np.flatnonzero(seen.has(pairs))
                        fresh = []
                        for j in keep.tolist():
                            fresh.append(digests[j] not in met)
                            met.add(digests[j])
                        at = pa.array(np.full(len(keep), k))
                        columns = [pa.array(pairs[keep, 0].view(np.int64)), pa.array(pairs[keep, 1].view(np.int64)), batch.column(0).take(at), batch.column(1).take(at)]
                        columns += [pa.array(np.array(lines, np.int64)[keep] + number), pa.array(fresh, pa.bool_())]
                        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "rid", "id", "line", "fresh"])
                    number += len(part)

    return rows.mapInArrow(emit, f"a bigint, b bigint, rid binary, id {kind}, line bigint, fresh boolean")


def _with_rid(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with ``_rid``, a fingerprint of id and text: rows that share it lose the same lines."""
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))
    return docs.withColumn("_rid", F.unhex(F.md5(F.concat(name, F.lit("\n"), F.coalesce(F.col(text), F.lit(""))))))


def _without(raw: bytes, drop, min_chars: int) -> tuple[bytes | None, int, int]:
    """(the kept lines or None where all are kept, lines, dropped lines); ``drop`` gets the keys of some lines and the
    number of the first."""
    kept: list[bytes] = []
    number = gone = 0
    for part in lines_of(raw):
        out = drop(keys_of(part, min_chars), number)
        number += len(part)
        lost = sum(out)
        gone += lost
        kept.extend([line for line, o in zip(part, out, strict=True) if not o] if lost else part)
    return (b"\n".join(kept) if gone else None), number, gone


def _apply(rows: DataFrame, text: str, batch_drop, drop: tuple[str, ...], min_chars: int) -> DataFrame:
    """``rows`` with the lines dropped that ``batch_drop(batch)(row)`` says, and their numbers."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        column = string_column(batch, text)
        chosen = batch_drop(batch)
        texts, total, gone = [], [], []
        for k, raw in enumerate(_raw_rows(column)):
            kept, n, lost = _without(raw, chosen(k), min_chars)
            texts.append(raw if kept is None else kept)
            total.append(n)
            gone.append(lost)
        # Cutting at "\n" leaves valid UTF-8.
        made = pa.array(texts, pa.binary(), mask=np.asarray(column.is_null())).cast(pa.string())
        return [made, pa.array(total, pa.int64()), pa.array(gone, pa.int64())]

    return with_arrow_columns(rows, f"`{text}` string, n_lines bigint, n_dropped bigint", run, drop)


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep: str = "none", key: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the lines whose keys are in ``min_docs`` documents or more; adds n_lines (before) and n_dropped."""
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more: the filters tell repeats only")
    seen = repeat_filter(docs, text, count_lines(docs, text), min_chars)
    size = F.count(F.lit(1)).alias("n")
    if keep == "none":
        counted = suspect_counts(docs, text, seen, min_chars).where(F.col("n") >= min_docs)
        confirmed, found = materialize_observed(counted.select("a", "b"), size, name="confirmed")
        if 16 * int(found["n"]) <= broadcast_bytes:
            return _drop_in_place(docs, text, confirmed, min_chars)
        lines = suspect_lines(docs, key, text, seen, min_chars)
        gone = lines.join(confirmed, ["a", "b"])
    else:
        lines = materialize(suspect_lines(docs, key, text, seen, min_chars), "suspects")
        counted = lines.groupBy("a", "b").agg(F.sum(F.col("fresh").cast("long")).alias("n"), F.min(F.struct("id", "line")).alias("first"))
        confirmed = counted.where(F.col("n") >= min_docs).select("a", "b", "first")
        gone = lines.join(confirmed, ["a", "b"]).where(~F.struct("id", "line").eqNullSafe(F.col("first")))
    numbers = materialize(gone.groupBy("rid").agg(F.collect_set("line").alias("_lines")), "dropped")
    rows = _with_rid(docs, key, text)
    rows = rows.join(numbers, rows["_rid"] == numbers["rid"], "left").drop("rid", "_rid")

    def by_number(batch: pa.RecordBatch):
        wanted = batch.column(batch.schema.get_field_index("_lines"))

        def row(k: int):
            chosen = set(wanted[k].as_py() or ())
            return lambda keys, first: [first + j in chosen for j in range(len(keys))]

        return row

    return _apply(rows, text, by_number, ("_lines",), min_chars)


def _drop_in_place(docs: DataFrame, text: str, confirmed: DataFrame, min_chars: int) -> DataFrame:
    pairs = confirmed.toPandas().to_numpy(np.int64).astype("<i8")  # BROADCAST_BYTES at most
    digests = {pairs[k].tobytes() for k in range(len(pairs))}

    def by_key(batch: pa.RecordBatch):
        return lambda k: lambda keys, first: [d in digests for d in keys]

    return _apply(docs, text, by_key, (), min_chars)


def digest(deduped: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return deduped.select(F.col(key).alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("kept_sha256"))


def oracle(docs: str, min_docs: int = MIN_DOCS) -> str:
    blank = "||".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))
    return f"""
        WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {docs}),
        lines AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS k FROM numbered),
        keyed AS (SELECT *, translate(trim(line, {blank}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= {min_docs}),
        marked AS (SELECT r, doc_id, line, k, key IN (SELECT key FROM common) AS gone FROM keyed)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY r, doc_id
    """
