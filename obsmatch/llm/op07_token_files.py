"""Token ids of whole texts in succinct files, one wavelet matrix for each shard of documents in key order.

Documents are dealt out by ranges of the key and sorted within them; each task encodes its range and starts a new
shard whenever the ids at hand reach ``shard_tokens``, so that memory is bounded whatever a range holds. A shard is one
row (its bytes, see ``wavelet_file.py``, and its documents' keys), and Spark writes one row a file into the shared folder:
task commits make that safe when executors are lost. Readers open a shard alone: access by place, counts and
occurrences of an id come from the planes without expanding them.

The ids are those of the tokenizer library for the whole text. Texts of ASCII and Latin-1 letters only, without
"<|" and without pieces over 64 bytes, are split as the tokenizer file's own pattern splits them, many texts at once on their
bytes, and each distinct piece is encoded by the library once a worker; all others go to the library whole. White space is
dropped by this tokenizer, so pieces do not interact. A worker tells pieces apart by 64 bits (the chance that two of its two
million are taken for one another is 10**-7).

Defined cases: null and empty texts have only the end id; null keys come first, and rows of one key stay
together in one range, in order of their texts, null first; an empty table gives no files and no rows; only the key and text columns
are read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from obsmatch.llm.common import slices, string_column, text_buffers
from obsmatch.llm.wavelet_file import WaveletFile, encode
from obsmatch.llm.words import _BASE, _INVERSE, mix, powers
from obsmatch.session import scratch_path

END = 2
SHARD_TOKENS = 4_000_000
#: Distinct pieces that a worker remembers before it starts afresh.
PIECES = 2_000_000

#: Bytes of the longest piece that is told apart by its hash.
LONGEST = 64

# The tokenizer file's split pattern (after lower-casing: contractions; runs of letters; single digits; runs of
# anything else but white space), with its classes written out for the bytes of ASCII and Latin-1 letters.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _CLASS[0x80:] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_APOSTROPHE = 0x27
_SHORT = b"stmd"
_LONG = (b"re", b"ve", b"ll")


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, start, end of every piece; whether each row is one that is split here).

    A row that is not may have any pieces.
    """
    n = len(data)
    low = _LOWER[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    follows = np.append(data[1:], 0)
    follows[edge[1:]] = 0  # nothing follows a row's last byte
    # Two bytes of a Latin-1 letter: the second lower-cased like ASCII; 0x97 and 0xB7 are the signs of arithmetic.
    pair = (data == 0xC3) & (follows >= 0x80) & (follows != 0x97) & (follows != 0xB7)
    second = np.flatnonzero(pair) + 1
    upper = second[(data[second] < 0x9F)]
    low[upper] += 0x20
    bad = np.zeros(n + 1, np.int64)
    strange = data >= 0x80
    strange &= ~pair
    strange[second] = False
    strange |= (data == 0x3C) & (follows == 0x7C)
    np.cumsum(strange, out=bad[1:])
    simple = bad[offsets[1:]] == bad[offsets[:-1]]

    kind = _CLASS[data]
    before = np.empty(n, np.uint8)
    before[1:], before[:1] = kind[:-1], _SPACE
    before[edge[:n]] = _SPACE
    first = (kind != _SPACE) & ((kind != before) | (kind == _DIGIT))
    # An apostrophe that no sign stands before, and some letters after it, are a piece.
    at = np.flatnonzero((data == _APOSTROPHE) & (before != _OTHER))
    if len(at):
        padded = np.concatenate([low, np.zeros(2, np.uint8)])
        one, two = padded[at + 1], padded[at + 2]
        inside = ~edge[np.minimum(at + 1, n)]
        inside_two = inside & ~edge[np.minimum(at + 2, n)]
        short = inside & np.isin(one, np.frombuffer(_SHORT, np.uint8))
        long = np.zeros(len(at), bool)
        for pair_ in _LONG:
            long |= inside_two & (one == pair_[0]) & (two == pair_[1])
        long &= ~short
        for hit, size in ((at[short], 2), (at[long], 3)):
            first[hit + 1] = False
            after = hit + size
            after = after[after < n]
            after = after[(kind[after] != _SPACE)]
            first[after] = True
    last = kind != _SPACE
    last[:-1] &= first[1:] | (kind[1:] == _SPACE) | edge[1:n]
    return low, np.flatnonzero(first), np.flatnonzero(last) + 1, simple


class Encoder:
    """Ids of whole texts, equal to the library's."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size()
        self.closes = np.array([(self.library.id_to_token(k) or "").endswith("</w>") for k in range(size)])
        self._reset()

    def _reset(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # of the known pieces, ascending, and their numbers
        self.number = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)  # of all known pieces, one after another
        self.at = np.zeros(1, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        """Encodes new pieces, many in one call: apart from white space each is a piece again, and its last id closes a word."""
        found = [self.ids]
        ends = [self.at]
        total = len(self.ids)
        for lo in range(0, len(pieces), 10_000):
            part = pieces[lo : lo + 10_000]
            ids = np.array(self.library.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            close = np.flatnonzero(self.closes[ids]) + 1
            if len(close) != len(part):  # not one closing id a piece: take them one at a time
                each = [self.library.encode(p, add_special_tokens=False).ids for p in part]
                ids = np.array([i for e in each for i in e], np.uint32)
                close = np.cumsum([len(e) for e in each])
            found.append(ids)
            ends.append(close + total)
            total += len(ids)
        self.ids, self.at = np.concatenate(found), np.concatenate(ends)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        return self.encode_bytes(*text_buffers(pa.array(texts, pa.large_string())))

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of UTF-8 texts that lie one after another."""
        if len(self.number) > PIECES:
            self._reset()
        low, start, end, simple = split(data, offsets)
        row = np.searchsorted(offsets, start, "right") - 1
        long = row[end - start > LONGEST]
        simple[long] = False
        use = simple[row]
        start, end, row = start[use], end[use], row[use]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(low)), out=total[1:])
        value = mix((total[end] - total[start]) * powers(_INVERSE, len(low) + 1)[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        known, where, inverse = np.unique(value, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, known)
        fresh = np.ones(len(known), bool)
        fresh[place < len(self.hashes)] = self.hashes[place[place < len(self.hashes)]] != known[place < len(self.hashes)]
        if fresh.any():
            view = low.tobytes()
            spans = zip(start[where[fresh]].tolist(), end[where[fresh]].tolist(), strict=True)
            self._learn([view[a:b].decode() for a, b in spans])
            self.number = np.insert(self.number, place[fresh], np.arange(len(self.hashes), len(self.hashes) + int(fresh.sum())))
            self.hashes = np.insert(self.hashes, place[fresh], known[fresh])
            place = np.searchsorted(self.hashes, known)
        piece = self.number[place][inverse] if len(known) else np.zeros(0, np.int64)
        begin, size = self.at[piece], self.at[piece + 1] - self.at[piece]
        ends = np.cumsum(size)
        ids = self.ids[np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size - begin, size)]
        piece_at = np.searchsorted(row, np.arange(len(offsets)))
        sums = np.concatenate([[0], ends])
        counts = sums[piece_at[1:]] - sums[piece_at[:-1]]
        if simple.all():
            return ids, counts
        other = np.flatnonzero(~simple).tolist()
        texts = [data[offsets[k] : offsets[k + 1]].tobytes().decode() for k in other]
        whole = dict(zip(other, self.library.encode_batch(texts, add_special_tokens=False), strict=True))
        parts = []
        for k in range(len(simple)):
            parts.append(np.array(whole[k].ids, np.uint32) if k in whole else ids[sums[piece_at[k]] : sums[piece_at[k + 1]]])
            counts[k] = len(parts[-1])
        return np.concatenate(parts), counts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END, shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes the shards of ``docs`` under ``folder``: rows (first, part, n_tokens, keys, body)."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        keys: list[pa.Array] = []
        counts: list[np.ndarray] = []
        held, part = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, part
            ends = np.cumsum(np.concatenate(counts))
            names = pa.concat_arrays(keys)
            body = encode(np.concatenate(ids), ends)
            lists = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            columns = [names.slice(0, 1), pa.array([part], pa.int64()), pa.array([int(ends[-1])], pa.int64()), lists, pa.array([body], pa.binary())]
            ids.clear(), keys.clear(), counts.clear()
            held, part = 0, part + 1
            return pa.RecordBatch.from_arrays(columns, names=["first", "part", "n_tokens", "keys", "body"])

        for batch in batches:
            own = string_column(batch, "key")
            data, offsets = text_buffers(string_column(batch, "text"))
            # About a megabyte of texts at a time, less where a shard is smaller.
            for lo, hi, part_bytes, part_at in slices(data, offsets, min(1 << 20, shard_tokens)):
                flat, n = encoder(tokenizer).encode_bytes(part_bytes, part_at)
                flat = np.insert(flat, np.cumsum(n), end)
                ids.append(flat.astype(np.uint32))
                counts.append(n + 1)
                keys.append(own.slice(lo, hi - lo))
                held += len(flat)
                if held >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    by_key = F.col("key").asc_nulls_first()
    ordered = rows.repartitionByRange(by_key).sortWithinPartitions(by_key, F.col("text").asc_nulls_first())
    schema = f"first {kind}, part bigint, n_tokens bigint, keys array<{kind}>, body binary"
    ordered.mapInArrow(shards, schema).write.option("maxRecordsPerFile", 1).parquet(folder)


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards of ``files``."""
    # A row a shard: the running sum over all of them is small.
    along = W.orderBy(F.col("first").asc_nulls_first(), "part").rowsBetween(W.unboundedPreceding, -1)
    base = files.select("first", "part", "n_tokens").withColumn("base", F.coalesce(F.sum("n_tokens").over(along), F.lit(0))).drop("n_tokens")
    kind = dict(files.dtypes)["first"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = WaveletFile(batch.column(3)[k].as_buffer().to_pybytes())
                ids = shard.decode().astype("<u4")
                at = np.concatenate([[0], shard.ends])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                keys = batch.column(2)[k].values
                one = np.full(len(keys), 0)
                yield pa.RecordBatch.from_arrays(
                    [keys, batch.column(0).take(pa.array(one + k)), batch.column(1).take(pa.array(one + k)), pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    names=["doc_id", "first", "part", "local", "n_tokens", "ids_crc32"],
                )

    rows = files.select("first", "part", "keys", "body").mapInArrow(digest, f"doc_id {kind}, first {kind}, part bigint, local bigint, n_tokens bigint, ids_crc32 bigint")
    same = rows["first"].eqNullSafe(base["first"]) & (rows["part"] == base["part"])
    return rows.join(base, same).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_token_files(docs, folder, tokenizer, **options)
    return read_token_files(spark.read.parquet(folder))
