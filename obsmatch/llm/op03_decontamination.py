"""Benchmark decontamination with an FM-index for each shard of documents.

Words are those of ``words.py`` (ASCII letters in lower case). The test phrases are the windows of 10 consecutive
words of the benchmark items; an item of fewer words, but not none, is one phrase. A shard is a slice of whole
documents inside a task: its words become symbols (the words of the phrases; all others end a segment), and its
FM-index is searched backward for all phrases at once. Occurrences are located from sampled suffix positions and
merged into removal spans of words. Nothing is shuffled, and a task holds one slice's index at a time.

The phrases are the stated query set. They reach the tasks in blocks of about ``block_words`` words, and each
block is a pass over the documents. All passes are one lazy plan, so the driver holds the phrases of all blocks.

Defined cases: null and empty texts have no words and no hits; a null item text has no phrases; an item with a
null id counts under the id ``null``; equal items are each listed; an empty benchmark hits nothing; the input's
columns are kept, but those named as an added one (n_words, n_hit, item_ids, hit_spans) are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmatch.llm.common import slices, string_column, text_buffers, with_arrow_columns
from obsmatch.llm.fm_index import FMIndex
from obsmatch.llm.words import word_spans

WINDOW = 10
#: Words of benchmark items that one pass searches for.
BLOCK_WORDS = 2_000_000
ADDED = "n_words bigint, n_hit bigint, item_ids array<string>, hit_spans array<struct<start:int,end:int>>"
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


@dataclass
class Phrases:
    """Distinct windows as symbols (1 and up; right-aligned), and the items of each."""

    vocabulary: np.ndarray  # sorted word hashes; symbol k + 1 is the k-th
    symbols: np.ndarray
    lengths: np.ndarray
    item_at: np.ndarray  # offsets into items, by window
    items: np.ndarray
    names: list[str]


def phrases(names: list[str], texts: list[str], window: int = WINDOW) -> Phrases:
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    _, _, values, at = word_spans(data, offsets)
    vocabulary, symbol = np.unique(values, return_inverse=True)
    found: dict[tuple[int, ...], list[int]] = {}
    for k in range(len(names)):
        words = (symbol[at[k] : at[k + 1]] + 1).tolist()
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            items = found.setdefault(tuple(words[i : i + window]), [])
            if not items or items[-1] != k:
                items.append(k)
    symbols = np.zeros((len(found), window), np.int64)
    for row, key in zip(symbols, found, strict=True):
        row[window - len(key) :] = key
    lengths = np.array([len(key) for key in found], np.int64)
    item_at = np.concatenate([[0], np.cumsum([len(v) for v in found.values()], dtype=np.int64)]).astype(np.int64)
    items = np.array([k for v in found.values() for k in v], np.int64)
    return Phrases(vocabulary, symbols, lengths, item_at, items, list(names))


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (count[0] of them), then the same for the next."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count - first, count)


def search_slice(data: np.ndarray, offsets: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the documents of a slice: word offsets, (first word, end word) of hits, and (document, item) pairs."""
    _, _, values, at = word_spans(data, offsets)
    empty = np.zeros(0, np.int64)
    if not len(values) or not len(p.lengths):
        return at, empty, empty, empty, empty
    place = np.searchsorted(p.vocabulary, values)
    place[place == len(p.vocabulary)] = 0
    symbol = np.where(p.vocabulary[place] == values, place + 1, 0)
    # Documents are set apart by a 0 before each; of neighbouring zeros one is enough.
    doc_first = at[:-1][np.diff(at) > 0]
    text = np.insert(symbol, doc_first, 0)
    word = np.insert(np.arange(len(values)), doc_first, -1)
    keep = text != 0
    keep[1:] |= text[:-1] != 0
    text, word = text[keep], word[keep]
    index = FMIndex(text, len(p.vocabulary) + 1)
    low, high = index.search(p.symbols, p.lengths)
    hit = np.flatnonzero(high > low)
    count = high[hit] - low[hit]
    rows = _expand(low[hit], count)
    phrase = np.repeat(hit, count)
    start = word[index.locate(rows)]
    end = start + p.lengths[phrase]
    doc = np.searchsorted(at, start, "right") - 1
    # A phrase that occurs often in a document, and that many items share, is expanded to its items once.
    met = np.unique(doc * len(p.lengths) + phrase)
    of, phrase = met // len(p.lengths), met % len(p.lengths)
    per = p.item_at[phrase + 1] - p.item_at[phrase]
    item = p.items[_expand(p.item_at[phrase], per)]
    pair = np.unique(np.repeat(of, per) * len(p.names) + item) if len(item) else empty
    return at, start, end, pair // max(1, len(p.names)), pair % max(1, len(p.names))


def merge_spans(at: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered words of each document, and the merged spans (start, end), which never cross documents."""
    n = int(at[-1])
    step = np.bincount(start, minlength=n + 1)[: n + 1] - np.bincount(end, minlength=n + 1)[: n + 1]
    covered = np.cumsum(step)[:n] > 0
    total = np.concatenate([[0], np.cumsum(covered)])
    first = covered.copy()
    first[1:] &= ~covered[:-1]
    inner = at[1:-1][at[1:-1] < n]
    first[inner] = covered[inner]
    last = covered.copy()
    last[:-1] &= ~covered[1:]
    last[inner[inner > 0] - 1] = covered[inner[inner > 0] - 1]
    return total[at[1:]] - total[at[:-1]], np.flatnonzero(first), np.flatnonzero(last) + 1


def decontaminate(docs: DataFrame, blocks: Iterator[Phrases], text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids (sorted, distinct) and hit_spans ([start, end) in words)."""
    out = docs
    for number, block in enumerate(blocks):
        out = _pass(out, block, text, first=number == 0)
    return out


def _pass(docs: DataFrame, p: Phrases, text: str, first: bool) -> DataFrame:
    def annotate(batch: pa.RecordBatch) -> list[pa.Array]:
        n_words, n_hit, ids, spans = [], [], [], []
        earlier_ids = None if first else string_column(batch, "item_ids").to_pylist()
        earlier = None if first else string_column(batch, "hit_spans").to_pylist()
        data, offsets = text_buffers(string_column(batch, text))
        for lo, hi, part, part_at in slices(data, offsets):
            at, start, end, doc, item = search_slice(part, part_at, p)
            if earlier is not None:  # the spans of the blocks before
                old = [(at[k] + s["start"], at[k] + s["end"]) for k in range(hi - lo) for s in earlier[lo + k]]
                start = np.concatenate([start, np.array([a for a, _ in old], np.int64)])
                end = np.concatenate([end, np.array([b for _, b in old], np.int64)])
            hits, a, b = merge_spans(at, start, end) if at[-1] else (np.zeros(hi - lo, np.int64),) + (np.zeros(0, np.int64),) * 2
            n_words.append(np.diff(at))
            n_hit.append(hits)
            items: list[set[str]] = [set(earlier_ids[lo + k]) if earlier_ids else set() for k in range(hi - lo)]
            for d, i in zip(doc.tolist(), item.tolist(), strict=True):
                items[d].add(p.names[i])
            ids += [sorted(x) for x in items]
            of = np.searchsorted(at, a, "right") - 1
            own: list[list[dict]] = [[] for _ in range(hi - lo)]
            for d, x, y in zip(of.tolist(), (a - at[of]).tolist(), (b - at[of]).tolist(), strict=True):
                own[d].append({"start": x, "end": y})
            spans += own
        number = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n_words, n_hit)]
        return [pa.array(number[0], pa.int64()), pa.array(number[1], pa.int64()), pa.array(ids, pa.list_(pa.string())), pa.array(spans, pa.list_(SPAN))]

    return with_arrow_columns(docs, ADDED, annotate)


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, item: str = "item_id", text: str = "text") -> Iterator[Phrases]:
    """The phrases of the benchmark's items, in blocks; at least one, which may be empty."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit("")))
    names, texts, size = [], [], 0
    for name, body in rows.toLocalIterator():
        if size and size + len(body) // 2 > block_words:
            yield phrases(names, texts, window)
            names, texts, size = [], [], 0
        names.append(name)
        texts.append(body)
        size += len(body) // 2  # a word and its end take two characters at least
    yield phrases(names, texts, window)


def digest(annotated: DataFrame, key: str = "doc_id") -> DataFrame:
    return annotated.select(
        key,
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def oracle(docs: str, benchmark: str, window: int = WINDOW) -> str:
    """DuckDB SQL for the digest, by joining every window of every document."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM {docs}),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {words} AS w FROM {benchmark}),
windows AS (
  SELECT DISTINCT item, least(len(w), {window}) AS size, array_to_string(w[i:i + least(len(w), {window}) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS i,
         unnest([array_to_string(w[k:k + size - 1], ' ') for k in range(1, len(w) - size + 2)]) AS phrase
  FROM d, sizes WHERE len(w) >= size
), hits AS (SELECT p.doc_id, p.i, p.size, v.item FROM places p JOIN windows v USING (size, phrase)
), spans AS (SELECT DISTINCT doc_id, i, size FROM hits),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM spans) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""
