"""Near-duplicate documents by BagMinHash signatures, bands and verified multiset overlap.

A document is the multiset of its runs of five words (words as in ``words.py``; a text of fewer words, but not
none, is one run). Signature: for each distinct run x and each dyadic range of weights (0,1], (1,2], (2,4], ... that
its count reaches into, a Poisson process seeded by (x, range) gives points in time, of rate the range's width;
each point falls on one signature component and one weight level, and counts if the level is at most x's count.
A component holds the earliest time that counts. Two documents agree on a component with probability equal to
their weighted Jaccard similarity. Points are drawn in order of time and only while they are earlier than the
latest component so far, so a long text costs about one draw for each run.

Steps: equal word sequences become one text class (128-bit fingerprint) with a number of its own, and ids come back only in
the last step, so what rows share an id does not matter before; signatures of 160 components in 32
bands of 5 give buckets; a bucket's members are compared, exactly, with its hub, the member that meets most
others; what that leaves unconnected is compared with everything in its bucket that it is not yet connected with, in
blocks. So no bucket is ever expanded into all its pairs, and no pair of a bucket whose verification could
change a class is left out. Links are pairs with similarity of 0.8 or more (sum of minima over sum of maxima).
Texts travel compressed, and only those of documents that share a bucket.
A pair at exactly 0.8 shares no bucket with probability (1 - 0.8**5)**32, about 3e-6.

Defined cases: texts without words (null, empty, only punctuation) have no runs and are near nothing; a row with a
null id is near nothing, is kept and has a null component; of a component's rows the one with the smallest id is kept, and of
several texts with that id the one with the smallest MD5; rows equal in id and text are one document, kept or not alike; an id
with several texts is in the class of each, row by row; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmatch.llm.common import groups, materialize, settle, slices, string_column, text_buffers, with_arrow_columns
from obsmatch.llm.components import components
from obsmatch.llm.words import mix, sequence_fingerprint, shingles, word_spans
from obsmatch.session import scratch_path, scratch_scope

SHINGLE = 5
#: Similarity at which two documents are linked, as a fraction.
NEAR = (4, 5)
BANDS, ROWS = 32, 5
#: Members that are compared with a hub, or with one another, at once: that many, or that many runs of theirs.
CHUNK = 256
CHUNK_RUNS = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bag_minhash(x: np.ndarray, count: np.ndarray, row: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Signatures (rows, size) of the bags whose distinct elements are ``x`` with ``count`` in ``row``; inf where
    a row has no element."""
    sig = np.full(rows * size, np.inf)
    # A process for each element and weight range below its count.
    parts = [(x, count, row, 0)]
    for level in range(1, int(count.max()).bit_length() + 1 if len(count) else 1):
        more = np.flatnonzero(count > (1 << (level - 1)))
        if not len(more):
            break
        parts.append((x[more], count[more], row[more], level))
    seed = np.concatenate([mix(p[0] + np.uint64((p[3] + 1) * int(_STEP) % (1 << 64))) for p in parts])
    own = np.concatenate([p[2] for p in parts]).astype(np.int64)
    width = np.concatenate([np.full(len(p[0]), 1.0 if p[3] == 0 else float(1 << (p[3] - 1))) for p in parts])
    below = np.concatenate([np.zeros(len(p[0])) if p[3] == 0 else np.full(len(p[0]), float(1 << (p[3] - 1))) for p in parts])
    share = np.minimum((np.concatenate([p[1] for p in parts]) - below) / width, 1.0)
    time = np.zeros(len(seed))
    drawn = 0
    while len(seed):
        block = 1 if len(seed) > 20_000 else 16
        number = np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64)
        h = mix(seed[:, None] + number * _STEP)
        wait = -np.log(((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / width[:, None]
        wait[:, 0] += time
        at = np.cumsum(wait, axis=1)
        g = mix(h ^ np.uint64(0xD1B54A32D192ED03))
        component = ((g >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
        ok = (g & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 < share[:, None]
        place = own[:, None] * size + component
        np.minimum.at(sig, place[ok], at[ok])
        drawn += block
        time = at[:, -1]
        alive = time < sig.reshape(rows, size).max(axis=1)[own]
        seed, own, width, share, time = seed[alive], own[alive], width[alive], share[alive], time[alive]
    return sig.reshape(rows, size)


def band_keys(sig: np.ndarray) -> np.ndarray:
    bits = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, bits.shape[:2]).copy()
    for k in range(ROWS):
        acc = mix(acc + bits[:, :, k] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k))
    return acc.view(np.int64)


def mark(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.coalesce(F.md5(text), F.lit(""))


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, mark, n_runs, hi, lo, bands) of every document; hi and lo are null and bands empty without words."""

    def sign(batch: pa.RecordBatch) -> list[pa.Array]:
        runs, his, los, bands, blank = [], [], [], [], []
        data, offsets = text_buffers(string_column(batch, "_text"))
        for lo_row, hi_row, part, part_at in slices(data, offsets):
            rows = hi_row - lo_row
            _, _, values, at = word_spans(part, part_at)
            hi, lo = sequence_fingerprint(values, at)
            sh, sh_at = shingles(values, at, SHINGLE)
            n = np.diff(sh_at)
            packed = np.sort((np.repeat(np.arange(rows, dtype=np.uint64), n) << np.uint64(48)) | (sh >> np.uint64(16)))
            first = np.ones(len(packed), bool)
            first[1:] = packed[1:] != packed[:-1]
            where = np.flatnonzero(first)
            count = np.diff(np.append(where, len(packed)))
            distinct = packed[where]
            row = (distinct >> np.uint64(48)).astype(np.int64)
            x = mix((distinct & np.uint64((1 << 48) - 1)) * _STEP)
            sig = bag_minhash(x, count, row, rows, BANDS * ROWS)
            runs.append(n)
            his.append(hi)
            los.append(lo)
            bands.append(band_keys(sig))
            blank.append(n == 0)
        none = np.concatenate(blank) if blank else np.zeros(0, bool)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        size = np.where(none, 0, BANDS)
        flat = join(bands)
        flat = flat[~none].ravel() if len(none) else flat
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat, pa.int64()))
        return [pa.array(join(runs), pa.int64()), pa.array(join(his), pa.int64(), mask=none), pa.array(join(los), pa.int64(), mask=none), lists]

    rows = docs.select(F.col(key).alias("id"), mark(F.col(text)).alias("mark"), F.col(text).alias("_text"))
    return with_arrow_columns(rows, "n_runs bigint, hi bigint, lo bigint, bands array<bigint>", sign, drop=("_text",))


def _bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element, row, elements by row): each run's n-th occurrence as an element of its own, so that multiset
    overlap is plain overlap."""
    data, offsets = text_buffers(texts)
    parts = []
    for _, _, part, part_at in slices(data, offsets, 1 << 20):
        _, _, values, at = word_spans(part, part_at)
        parts.append(shingles(values, at, SHINGLE))
    sh = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
    n = np.concatenate([np.diff(p[1]) for p in parts]) if parts else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((sh, row))
    sh = sh[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (row[1:] != row[:-1])
    number = np.arange(len(sh)) - np.maximum.accumulate(np.where(new, np.arange(len(sh)), 0))
    return mix(sh + number.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), row, n


def _near(common: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (common > 0) & (common * NEAR[1] >= (n + m - common) * NEAR[0])


def star_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (hub, rid) of the members of each group (hub, chunk) that are near the hub."""
    for t, at in groups(batches, ["hub", "chunk"], 2 << 20):
        hub, rid = t.column("hub").to_numpy(), t.column("rid").to_numpy()
        group = np.repeat(np.arange(len(at) - 1), np.diff(at))
        element, row, n = _bags(_unpack(t.column("z")))
        own = mix(element ^ mix(group.astype(np.uint64) + np.uint64(1))[row])
        is_hub = hub == rid
        lead = np.zeros(len(at) - 1, np.int64)
        lead[group[is_hub]] = np.flatnonzero(is_hub)
        of_hub = np.zeros(len(hub), bool)
        of_hub[lead] = True
        held = np.sort(own[of_hub[row]])
        if not len(held):
            continue
        found = held[np.minimum(np.searchsorted(held, own), len(held) - 1)] == own
        common = np.bincount(row[found], minlength=len(hub))
        near = _near(common, n, n[lead[group]]) & ~is_hub
        yield pa.RecordBatch.from_arrays([pa.array(hub[near], pa.int64()), pa.array(rid[near], pa.int64())], names=["a", "b"])


def block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between outsiders and all members of each block, as many as connect what they connect."""
    for t, at in groups(batches, ["bucket", "part", "chunk"], 2 << 20):
        rid, comp, outside = (t.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "comp", "outside"))
        element, row, n = _bags(_unpack(t.column("z")))
        row_at = np.concatenate([[0], np.cumsum(n)])
        a, b = [], []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            out, all_ = np.arange(lo, hi)[outside[lo:hi]], np.arange(lo, hi)[~outside[lo:hi]]
            if not len(out) or not len(all_):
                continue
            span = slice(int(row_at[lo]), int(row_at[hi]))
            e, r = element[span], row[span]
            shared = np.intersect1d(e[outside[r]], e[~outside[r]])
            common = np.zeros((len(out), len(all_)), np.float64)
            place = np.minimum(np.searchsorted(shared, e), max(len(shared) - 1, 0))
            known = (shared[place] == e) if len(shared) else np.zeros(len(e), bool)
            side = np.zeros(hi - lo, np.int64)
            side[out - lo], side[all_ - lo] = np.arange(len(out)), np.arange(len(all_))
            for c in range(0, len(shared), 1 << 14):  # columns at a time: bounded matrices
                use = known & (place >= c) & (place < c + (1 << 14))
                left = np.zeros((len(out), min(1 << 14, len(shared) - c)), np.float32)
                right = np.zeros((len(all_), left.shape[1]), np.float32)
                u = use & outside[r]
                left[side[r[u] - lo], place[u] - c] = 1
                u = use & ~outside[r]
                right[side[r[u] - lo], place[u] - c] = 1
                common += left @ right.T
            near = _near(common, n[out][:, None], n[all_][None, :]) & (comp[out][:, None] != comp[all_][None, :])
            parent: dict[int, int] = {}

            def root(x: int, parent: dict[int, int] = parent) -> int:
                while parent.get(x, x) != x:
                    x = parent[x]
                return x

            for i, j in zip(*(v.tolist() for v in np.nonzero(near)), strict=True):
                p, q = root(int(comp[out[i]])), root(int(comp[all_[j]]))
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    a.append(int(rid[out[i]]))
                    b.append(int(rid[all_[j]]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _packed(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(rid, z) with the texts compressed, of the rows that ``wanted`` (rid, id, mark) names, one for each rid."""
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).withColumn("_mark", mark(F.col("_text")))

    def pack(batch: pa.RecordBatch) -> list[pa.Array]:
        from zstandard import ZstdCompressor

        data, at = text_buffers(string_column(batch, "_text"))
        press = ZstdCompressor(level=3).compress
        view = memoryview(np.ascontiguousarray(data))
        return [pa.array([press(view[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())]

    packed = with_arrow_columns(rows, "z binary", pack, drop=("_text",))
    # Rows equal in id and text are copies, so any of them will do.
    return packed.join(wanted.hint("merge"), (F.col("_id") == F.col("id")) & (F.col("_mark") == F.col("mark"))).dropDuplicates(["id", "mark"]).select("rid", "z")


def _unpack(column: pa.ChunkedArray) -> pa.Array:
    from zstandard import ZstdDecompressor

    unpress = ZstdDecompressor().decompress
    return pa.array([unpress(z.as_buffer()) if z.is_valid else b"" for z in column], pa.binary()).cast(pa.string())


def _chunks(n: str, runs: str) -> Column:
    return F.ceil(F.greatest(F.col(n) / CHUNK, F.col(runs) / CHUNK_RUNS)).cast("int")


def _compare_with_hub(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among (hub, rid, n_runs): members in chunks, each with a copy of its hub."""
    chunks = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.sum("n_runs").alias("runs")).select("hub", _chunks("n", "runs").alias("chunks"))
    members = pairs.join(chunks, "hub").select("hub", F.pmod(F.xxhash64("rid"), F.col("chunks")).cast("int").alias("chunk"), "rid")
    hubs = chunks.select("hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("hub").alias("rid"))
    rows = members.union(hubs).join(texts.hint("merge"), "rid").select("hub", "chunk", "rid", "z")
    return rows.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk").mapInArrow(star_links, "a bigint, b bigint")


def _compare_blocks(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between each bucket's members outside its largest component and all its members."""
    sizes = rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_runs").alias("runs"))
    buckets = sizes.groupBy("bucket").agg(F.max(F.struct("n", "comp", "runs")).alias("most"), F.sum("n").alias("n"), F.sum("runs").alias("runs"))
    buckets = buckets.withColumn("out_n", F.col("n") - F.col("most.n")).withColumn("out_runs", F.col("runs") - F.col("most.runs"))
    buckets = buckets.select("bucket", F.col("most.comp").alias("main"), _chunks("out_n", "out_runs").alias("parts"), _chunks("n", "runs").alias("chunks"))
    own = rows.join(buckets, "bucket").withColumn("p", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int"))
    own = own.withColumn("c", F.pmod(F.xxhash64("rid", F.lit(1)), F.col("chunks")).cast("int"))
    outside = own.where("comp <> main").select("bucket", F.col("p").alias("part"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "rid", "comp", F.lit(True).alias("outside"))
    inside = own.select("bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("c").alias("chunk"), "rid", "comp", F.lit(False).alias("outside"))
    blocks = outside.union(inside).join(texts.hint("merge"), "rid").select("bucket", "part", "chunk", "rid", "comp", "outside", "z")
    keys = ["bucket", "part", "chunk"]
    return blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(block_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component_id, kept, mark) of every row: the smallest id of its component, and whether the row is the one to keep."""
    signed = materialize(signatures(docs, key, text), "signatures")
    known = signed.where("id is not null and hi is not null")
    # One row a text class, numbered; the row with the smallest id and mark stands for it.
    first = F.min(F.struct("id", "mark", "n_runs", "bands")).alias("first")
    classes = known.groupBy("hi", "lo").agg(first).select("hi", "lo", "first.*", F.monotonically_increasing_id().alias("rid"))
    classes = materialize(classes, "classes")
    entries = classes.select("rid", "n_runs", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    # Merge joins whatever the size: both sides grow with the corpus, and AQE splits a hot bucket.
    members = materialize(entries.join(shared.hint("merge"), "bucket").distinct(), "entries")
    # Buckets of the same members, as near copies have in many bands, are one.
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("least"), F.bit_xor(F.xxhash64("rid")).alias("x"))
    buckets = buckets.where("n > 1").groupBy("n", "least", "x").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    members = materialize(members.join(buckets, "bucket"), "members")
    met = members.groupBy("rid").agg(F.sum("n").alias("met"))
    hubs = members.join(met, "rid").groupBy("bucket").agg(F.max_by("rid", F.struct("met", -F.col("rid"))).alias("hub"))
    members = materialize(members.join(hubs, "bucket"), "hubs")
    wanted = classes.select("rid", "id", "mark").join(members.select("rid").distinct(), "rid", "left_semi")
    texts = materialize(_packed(docs, wanted, key, text), "texts")

    pairs = members.where("rid <> hub").select("hub", "rid", "n_runs").distinct()
    links = materialize(_compare_with_hub(pairs, texts), "links")
    comp, state = _open_buckets(members, links)
    if not state.isEmpty():
        links = links.union(_compare_blocks(state, texts))
        comp = components(links)

    # Ids from here on: a component is named by its smallest id, and the row that stands for that id is kept.
    placed = classes.join(comp, F.col("rid") == F.col("node"), "left").select("hi", "lo", "id", "mark", F.coalesce("component", "rid").alias("component"))
    placed = materialize(placed, "components")
    keeper = placed.groupBy(F.col("component").alias("_component")).agg(F.min(F.struct("id", "mark")).alias("keep"))
    named = placed.join(keeper, F.col("component") == F.col("_component")).select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), "keep")
    out = signed.join(named, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")) & F.col("id").isNotNull(), "left")
    kept = F.coalesce((F.col("id") == F.col("keep.id")) & (F.col("mark") == F.col("keep.mark")), F.lit(True))
    return out.select(F.col("id").alias(key), F.coalesce("keep.id", "id").alias("component_id"), kept.alias("kept"), "mark")


def _open_buckets(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The components so far, and the members, with these, of the buckets of three or more that hold several of them."""
    comp = components(links)
    rows = members.where("n > 2").join(comp, members["rid"] == comp["node"], "left").select("bucket", "rid", "n_runs", F.coalesce("component", "rid").alias("comp"))
    rows = materialize(rows, "placed")
    still = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    return comp, materialize(rows.join(still, "bucket"), "open")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component; rows with a null id all stay."""
    spark = docs.sparkSession
    path = scratch_path(spark, "kept")
    with scratch_scope(spark):  # nothing of the search but its result outlives it
        kept = near_duplicates(docs, key, text).where(F.col("kept") & F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col("mark").alias("_kept"))
        kept.distinct().write.parquet(path)
    del kept
    settle(spark)  # its shuffles go before the documents are shuffled
    kept = spark.read.parquet(path)
    rows = docs.where(F.col(key).isNotNull()).withColumn("_mark", mark(F.col(text)))
    one = rows.join(kept, (F.col(key) == F.col("_id")) & (F.col("_mark") == F.col("_kept")), "left_semi").dropDuplicates([key, "_mark"])
    return one.drop("_mark").unionByName(docs.where(F.col(key).isNull()))


def oracle(docs: str) -> str:
    """All pairs that share a run, for tables of some thousand rows."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    run = f"array_to_string(w[k:k + {SHINGLE - 1}], ' ')"
    return f"""
        WITH RECURSIVE rows_ AS (SELECT row_number() OVER () AS r, doc_id, md5(text) AS mark, {words} AS w FROM {docs}),
        runs AS (SELECT r, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS k, w FROM rows_ WHERE len(w) > 0 AND doc_id IS NOT NULL),
        bags AS (SELECT r, {run} AS x, count(*) AS c FROM runs GROUP BY ALL),
        sizes AS (SELECT r, sum(c) AS n FROM bags GROUP BY r),
        shared AS (SELECT a.r AS a, b.r AS b, sum(least(a.c, b.c)) AS common FROM bags a JOIN bags b ON a.x = b.x AND a.r <> b.r GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes s ON s.r = a JOIN sizes t ON t.r = b WHERE {NEAR[1]} * common >= {NEAR[0]} * (s.n + t.n - common)),
        reach AS (SELECT r, r AS low FROM rows_ UNION SELECT l.b, reach.low FROM reach JOIN links l ON l.a = reach.r),
        comp AS (SELECT r, min(low) AS low FROM reach GROUP BY r),
        keep AS (SELECT low, min(struct_pack(id := doc_id, mark := coalesce(mark, ''))) AS first FROM comp JOIN rows_ USING (r) GROUP BY low)
        SELECT doc_id, CASE WHEN doc_id IS NOT NULL THEN first.id END AS component_id,
            doc_id IS NULL OR (first.id = doc_id AND first.mark = coalesce(mark, '')) AS kept
        FROM rows_ JOIN comp USING (r) JOIN keep USING (low)
    """
