"""Language identification with blended-spectrum string kernels.

A text is the set of its byte n-grams (1 to 5 bytes, A-Z lower-cased, every run of bytes below 0x41 that is not an
apostrophe as one space): presence, not counts. The kernel of two texts is the number of n-grams they share, over the
geometric mean of their own numbers. A text longer than ``SLICE`` is all of its consecutive slices of about equal
length, at most that long, and its kernel the mean of theirs: presence over a whole long text would be nearly all
n-grams in any language. N-grams across a border count for the slice they start in. Landmarks are a bounded sample of the labelled texts; the Nystroem map of the
kernel on them feeds one ridge regression for each language against the rest. N-grams are addressed by hash, so a
block of texts is a 0/1 matrix, and kernel and regression come down to matrix products: landmark products,
Nystroem map and ridge weights are folded into one matrix of n-grams by languages, and a text's scores are its row
times that matrix, over the root of its number of n-grams.

Every language of the labelled documents is learned, from at most ``PER_LANGUAGE`` of its ids (those with the lowest
hashes, so the choice does not depend on order or partitions; of an id with several texts, the text with the lowest
hash) and no more of them once they have ``LANGUAGE_BYTES``. Landmarks' rows and the sums of the regression are made by
Spark; the driver holds 65,536 numbers for each landmark (256, or two of each language) and for each language, and no
text. Predictions read the whole text, and nothing else.

Defined cases: null texts and texts without a letter get ``und`` and score 0, as do all texts when nothing was
learned; ties go to the first language in order; a null id is never learned from; repeated rows are predicted
alike; an empty table gives no rows; input columns named as an added one (lang_pred, score) are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from obsmatch.llm.common import materialize, slices, string_column, text_buffers, with_arrow_columns

UNDETERMINED = "und"
#: Bound of the sample: labelled documents of a language.
PER_LANGUAGE = 400
#: A language's sample takes no further document once it has this many bytes.
LANGUAGE_BYTES = 16 << 20
#: Landmarks in all, shared evenly by the languages, two of each at least.
LANDMARKS = 256
#: Tasks that sum up the regression; each sends its sums to the driver.
SUM_TASKS = 16
LENGTHS = (1, 2, 3, 4, 5)
SLOTS = 1 << 16
#: Bytes of a text whose n-grams are one set.
SLICE = 10_000
RIDGE = 1e-2
ADDED = "lang_pred string, score double"

_FOLD = np.arange(256).astype(np.uint8)
_FOLD[:0x41] = 0x20
_FOLD[0x27] = 0x27
_FOLD[0x5B:0x61] = 0x20
_FOLD[0x7B:0x80] = 0x20
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (SLOTS, languages)


def sliced_grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, n-gram slots present, ascending) of each slice of each row; an empty row has one slice."""
    folded = _FOLD[data]
    for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        body = _body(folded[lo:hi])
        parts = max(1, -(-len(body) // SLICE))
        for k in range(parts):
            end = len(body) * (k + 1) // parts
            yield row, _slots(body[len(body) * k // parts : end + (LENGTHS[-1] - 1 if end < len(body) else 0)])


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The n-gram slots present in each slice of each row, ascending."""
    return (slots for _, slots in sliced_grams(data, offsets))


def _present(text: np.ndarray) -> np.ndarray:
    return _slots(_body(text))


def _body(text: np.ndarray) -> np.ndarray:
    if not len(text):
        return text
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 0x20) | (text[:-1] != 0x20)  # a run of spaces is one
    return np.concatenate([[0x20], text[keep], [0x20]]).astype(np.uint8)


def _slots(body: np.ndarray) -> np.ndarray:
    if not len(body):
        return np.zeros(0, np.int64)
    body = body.astype(np.uint64)
    seen = np.zeros(SLOTS, bool)
    acc = body.copy()
    for length in LENGTHS:
        if length > 1:
            if len(acc) < 2:
                break
            acc = (acc[:-1] << np.uint64(8)) | body[length - 1 :]
        h = (acc + np.uint64(length << 56)) * np.uint64(0x9E3779B97F4A7C15)
        seen[(h >> np.uint64(48)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def text_rows(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Each row as a vector of SLOTS: the mean of its slices' 0/1 vectors, each over the root of its number of n-grams."""
    last, count, out = 0, 0, np.zeros(SLOTS, np.float32)
    for row, slots in sliced_grams(data, offsets):
        if row != last:
            yield out / count
            last, count, out = row, 0, np.zeros(SLOTS, np.float32)
        count += 1
        if len(slots):
            out[slots] += np.float32(1 / np.sqrt(len(slots)))
    if count:
        yield out / count


def fit(texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """The first texts of each language, ``landmarks`` in all, span the Nystroem space; all texts train."""
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    use = np.flatnonzero(np.diff(offsets)).tolist()
    languages = sorted({labels[k] for k in use})
    if not languages:
        return Model([], np.zeros((SLOTS, 0)))
    codes = np.searchsorted(languages, [labels[k] for k in use])
    chosen = sorted(k for c in range(len(languages)) for k in np.flatnonzero(codes == c)[: _landmarks_each(len(languages), landmarks)])
    rows = (r for r, size in zip(text_rows(data, offsets), np.diff(offsets), strict=True) if size)
    base = np.stack([next(text_rows(data[offsets[k] : offsets[k + 1]], np.array([0, offsets[k + 1] - offsets[k]]))) for k in (use[j] for j in chosen)])
    lift = _lift(base)
    gram, sums = np.zeros((lift.shape[1],) * 2), np.zeros((len(languages), lift.shape[1]))
    _add_sums(rows, codes, 1 / np.bincount(codes), base, lift, gram, sums)
    return _solve(languages, base, lift, gram, sums, ridge)


def _landmarks_each(languages: int, landmarks: int = LANDMARKS) -> int:
    return max(2, landmarks // languages)


def _lift(base: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh((base @ base.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    return vectors[:, good] / np.sqrt(values[good])  # K_mm ** -1/2 on its range


def _add_sums(rows: Iterator[np.ndarray], codes: np.ndarray, weight: np.ndarray, base: np.ndarray, lift: np.ndarray, gram: np.ndarray, sums: np.ndarray, block: int = 64) -> None:
    """Adds the texts' weighted feature products to ``gram``, and their weighted features to their language's row of ``sums``."""
    for lo in range(0, len(codes), block):
        part = codes[lo : lo + block]
        features = (np.stack(list(islice(rows, len(part)))) @ base.T) @ lift
        weighted = features * weight[part][:, None]
        gram += weighted.T @ features
        np.add.at(sums, part, weighted)


def _solve(languages: list[str], base: np.ndarray, lift: np.ndarray, gram: np.ndarray, sums: np.ndarray, ridge: float = RIDGE) -> Model:
    """Every language weighs the same, however many texts it has; its texts' target is 1, that of all others -1."""
    target = 2 * sums.T - sums.sum(axis=0)[:, None]
    folded = lift @ np.linalg.solve(gram + ridge * np.eye(len(gram)) * np.trace(gram) / len(gram), target)
    weights = np.empty((SLOTS, len(languages)))
    for lo in range(0, SLOTS, 4096):
        weights[lo : lo + 4096] = base[:, lo : lo + 4096].T.astype(np.float64) @ folded
    return Model(languages, weights)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    lower = data | 0x20
    count = np.concatenate([[0], np.cumsum((lower >= 0x61) & (lower <= 0x7A) & (data < 0x80))])
    out = count[offsets[1:]] > count[offsets[:-1]]
    for k in np.flatnonzero(~out):  # letters beyond ASCII
        out[k] = any(c.isalpha() for c in data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace"))
    return out


def score(data: np.ndarray, offsets: np.ndarray, model: Model, block: int = 64) -> np.ndarray:
    """One-versus-rest outputs: the mean over a text's slices, a block of slices at a time."""
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    count = np.zeros(len(out))
    found = sliced_grams(data, offsets)
    while part := list(islice(found, block)):
        at, present = np.array([row for row, _ in part]), [slots for _, slots in part]
        size = np.sqrt(np.maximum([len(p) for p in present], 1))
        slots, inverse = np.unique(np.concatenate(present), return_inverse=True)
        rows = np.zeros((len(part), len(slots)))
        rows[np.repeat(np.arange(len(part)), [len(p) for p in present]), inverse] = 1
        np.add.at(out, at, rows @ model.weights[slots] / size[:, None])
        np.add.at(count, at, 1)
    return out / np.maximum(count, 1)[:, None]


def identify(docs: DataFrame, model: Model, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1: half of one plus the winner's output, cut to that range)."""

    def predict(batch: pa.RecordBatch) -> list[pa.Array]:
        names, scores = [], []
        data, offsets = text_buffers(string_column(batch, text))
        for lo, hi, part, at in slices(data, offsets):
            if not model.languages:
                names += [UNDETERMINED] * (hi - lo)
                scores.append(np.zeros(hi - lo))
                continue
            outputs = score(part, at, model)
            best = outputs.argmax(axis=1)
            known = _has_letter(part, at)
            names += [model.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            top = np.clip((outputs[np.arange(hi - lo), best] + 1) / 2, 0, 1)
            scores.append(np.where(known, top, 0.0))
        return [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())]

    return with_arrow_columns(docs, ADDED, predict, drop)


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """The model of the labelled documents that are not held out."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = rows.where(F.col("id").isNotNull() & ~held_out("id") & F.col("lang").isNotNull() & (F.col("lang") != UNDETERMINED) & (F.length("text") > 0))
    mark = F.struct(F.xxhash64("text").alias("mark"), F.octet_length("text").alias("size"))
    ids = usable.groupBy("lang", "id").agg(F.min(mark).alias("one")).select("lang", "id", "one.*")
    # Spark keeps the first of each language in every task before it shuffles ids (a group limit below the window).
    first = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = ids.withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language)
    before = F.sum("size").over(W.partitionBy("lang").orderBy("k").rowsBetween(W.unboundedPreceding, -1))
    chosen = chosen.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < LANGUAGE_BYTES)
    chosen = materialize(chosen.select(F.col("lang").alias("lang_"), F.col("id").alias("id_"), F.col("mark").alias("mark_"), "k"), "chosen")
    counts = {r["lang_"]: r["n"] for r in chosen.groupBy("lang_").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((SLOTS, 0)))
    # At most ``per_language`` rows of a language, without texts.
    same = (F.col("lang") == F.col("lang_")) & (F.col("id") == F.col("id_")) & (F.xxhash64("text") == F.col("mark_"))
    sample = materialize(usable.join(F.broadcast(chosen), same).dropDuplicates(["lang_", "id_"]).select("lang", "k", "text"), "sample")
    return _fit_sample(sample, counts)


def _fit_sample(sample: DataFrame, counts: dict[str, int]) -> Model:
    """The model of ``sample`` (lang, k from 1 in each language, text), whose rows are read and summed by tasks."""
    languages = sorted(counts)
    weight = np.array([1.0 / counts[c] for c in languages])
    code = {c: j for j, c in enumerate(languages)}

    def landmark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(np.flatnonzero(r), r) for r in text_rows(*text_buffers(batch.column(2)))]
            parts = [pa.array([f.tobytes() for f in found], pa.binary()) for found in ([at.astype(np.int32) for at, _ in rows], [r[at] for at, r in rows])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *parts], names=["lang", "k", "at", "value"])

    few = sample.where(F.col("k") <= _landmarks_each(len(languages))).mapInArrow(landmark, "lang string, k int, at binary, value binary")
    spanning = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["value"], np.float32)) for r in sorted(few.collect(), key=lambda r: (r["lang"], r["k"]))]

    def dense() -> np.ndarray:
        out = np.zeros((len(spanning), SLOTS), np.float32)
        for k, (at, value) in enumerate(spanning):
            out[k, at] = value
        return out

    base = dense()
    lift = _lift(base)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, seen = None, False
        gram, sums = np.zeros((lift.shape[1],) * 2), np.zeros((len(languages), lift.shape[1]))
        for batch in batches:
            if not batch.num_rows:
                continue
            here, seen = dense() if here is None else here, True
            codes = np.array([code[c] for c in batch.column(0).to_pylist()])
            _add_sums(text_rows(*text_buffers(batch.column(2))), codes, weight, here, lift, gram, sums)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())], names=["gram", "sums"])

    gram, sums = np.zeros((lift.shape[1],) * 2), np.zeros((len(languages), lift.shape[1]))
    for r in sample.repartition(SUM_TASKS).mapInArrow(add, "gram binary, sums binary").collect():
        gram += np.frombuffer(r["gram"]).reshape(gram.shape)
        sums += np.frombuffer(r["sums"]).reshape(sums.shape)
    return _solve(languages, base, lift, gram, sums)


def language_query(docs: DataFrame) -> DataFrame:
    model = learn(docs)
    rows = docs.select("doc_id", "text", held_out("doc_id").alias("held_out"))
    return identify(rows, model, drop=("text",))
