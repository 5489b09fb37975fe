"""Merkle manifest of a dataset by lag and lead windows, in DataFrame operations only.

A row is a leaf: H (lowercase hex SHA-256) of its values, each as its number of UTF-8 bytes, ``:`` and the value, or ``-`` for
null. Per group the leaves ascend by key; while several nodes remain, every 16 consecutive ones (the last run may be
shorter, even one) become the H of their hex digests. What remains is the group's subroot; the subroots in order of the
group (null first, bytewise) become the root in the same way.

A node's place within its group is known before any hashing: rows are dealt out by range of (group, key, leaf) and a salt,
sorted and written; a row's number within its range, the number of rows of each range and their running sums (a row
for each range and group) give the place. So a group with a third of all rows, or one row repeated that often, is spread over
all ranges. Then 4,096 consecutive nodes are one window partition, which covers three levels with one exchange and one sort.
At each level a node stands in the row of its first leaf; columns of fixed offsets (1 to 15 times 16**level rows) behind
and ahead, masked by the node's slot in its run and by the run's length, supply its siblings, and the first child's row
hashes the parent. Partition roots are the nodes of the next three levels: a 4,096th of the rows. Siblings flow back down
by one join for each three levels, on the keys that the rows are partitioned by already.

A proof is the list of (left, right) siblings' digests from the leaf to the root; ``fold`` recomputes the root from a leaf and
its proof. Levels at which a group had one node already are not in it.

Defined cases: a null key comes first; rows of one key ascend by their leaf, and equal rows are leaves of their own; a null
group is a group; values are rendered as Spark casts them to text; an empty table gives no rows and no root; only the
key, group and value columns are read, by name, so extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsmatch.llm.common import materialize
from obsmatch.session import materialize_observed

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
#: Levels in one window partition.
LEVELS = 3
BLOCK_BITS = FANOUT_BITS * LEVELS
VALUES = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return h(*[encoded(v) for v in values])


def fold(path: Column, start: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda digest, level: h(level["left"], digest, level["right"]))


def proof_digest(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def placed(nodes: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``nodes`` (grp, digest, the columns ``order``, others) with pos, from 0 within its group by ``order`` and digest, and n,
    the group's number of nodes; and the largest n."""
    keys = [F.col("grp").asc(), *[F.col(c).asc_nulls_first() for c in order], F.col("digest").asc(), F.col("_salt").asc()]
    dealt = nodes.withColumn("_salt", F.rand(17)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt")
    # The upper bits are the range, the lower 33 the row's number within it.
    table = materialize(dealt.withColumn("_row", F.monotonically_increasing_id()), "ranges")
    here = F.shiftright("_row", 33).alias("_range")
    ranges = table.groupBy("grp", here).agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    before = W.partitionBy("grp").orderBy("_range")
    ranges = ranges.select(
        F.col("grp").alias("_grp"), F.col("_range").alias("_at"), "_first",
        (F.sum("_rows").over(before) - F.col("_rows")).alias("_before"), F.sum("_rows").over(W.partitionBy("grp")).alias("n"),
    )
    ranges, found = materialize_observed(ranges, F.max("n").alias("most"), name="range-sizes")
    same = (table["grp"] == ranges["_grp"]) & (F.shiftright(table["_row"], 33) == ranges["_at"])
    out = table.join(ranges, same).withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before"))
    return out.drop("_row", "_grp", "_at", "_first", "_before"), int(found["most"] or 0)


def _blocks(nodes: DataFrame) -> DataFrame:
    """``nodes`` (grp, pos, n, digest, ...) with the siblings of three levels (path) and, in the row of a block's first node,
    the block's digest (_top)."""
    w = W.partitionBy("grp", "block").orderBy("pos")
    carried = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = nodes.withColumn("block", F.shiftright("pos", BLOCK_BITS)).withColumn("_top", F.col("digest"))
    names = []
    for level in range(LEVELS):
        bits = FANOUT_BITS * level
        stride = 1 << bits
        nodes_here = F.shiftright(F.col("n") + F.lit(stride - 1), bits)  # ceil(n / 16**level)
        first = F.col("pos").bitwiseAND(F.lit(stride - 1)) == 0
        place = F.shiftright("pos", bits)
        slot = place.bitwiseAND(F.lit(FANOUT - 1))
        ahead = nodes_here - 1 - place  # nodes of the group behind this one
        several = nodes_here > 1
        left = [F.when(slot >= k, F.lag("_top", k * stride).over(w)) for k in range(FANOUT - 1, 0, -1)]
        right = [F.when((slot + k < FANOUT) & (ahead >= k), F.lead("_top", k * stride).over(w)) for k in range(1, FANOUT)]
        rows = rows.select("*", F.when(first & several, F.concat_ws("", *left)).alias("_l"), F.when(first & several, F.concat_ws("", *right)).alias("_r"))
        parent = F.when(several, F.when(first & (slot == 0), h(F.col("_l"), F.col("_top"), F.col("_r")))).otherwise(F.col("_top"))
        name = f"_level{level}"
        names.append(name)
        siblings = F.when(F.col("_l").isNotNull(), F.struct(F.col("_l").alias("left"), F.col("_r").alias("right")))
        spread = siblings if level == 0 else F.last(siblings, ignorenulls=True).over(carried)
        rows = rows.select(*[c for c in rows.columns if c not in ("_l", "_r", "_top")], spread.alias(name), parent.alias("_top"))
    return rows.select(*[c for c in rows.columns if c not in names], F.array_compact(F.array(*names)).cast(PATH).alias("path"))


def grown(nodes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(``nodes`` with block and path up to their group's root, (grp, digest) of the groups' roots)."""
    rows = _blocks(nodes)
    # Written once: the next levels and the way back down read it.
    rows = materialize(rows, "nodes")
    first = F.col("pos").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) == 0
    tops = rows.where(first).select("grp", F.col("block").alias("pos"), F.shiftright(F.col("n") + F.lit((1 << BLOCK_BITS) - 1), BLOCK_BITS).alias("n"), F.col("_top").alias("digest"))
    rows = rows.drop("_top")
    if most <= 1 << BLOCK_BITS:
        return rows, tops.select("grp", "digest")
    upper, roots = grown(tops, -(-most // (1 << BLOCK_BITS)))
    above = upper.select(F.col("grp").alias("_grp"), F.col("pos").alias("_block"), F.col("path").alias("_above"))
    joined = rows.join(above, (F.col("grp") == F.col("_grp")) & (F.col("block") == F.col("_block")))
    path = F.concat("path", "_above")
    return joined.select(*[c for c in rows.columns if c != "path"], path.alias("path")), roots


def group_name(group: Column) -> Column:
    """Text that is ordered like the group, null first, and never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


@dataclass
class Manifest:
    """The leaves (the columns kept, grp, digest, pos, path from leaf to root, subroot) and the root (None for no rows)."""

    leaves: DataFrame
    root: str | None


def manifest(leaves: DataFrame, order: list[str]) -> Manifest:
    """The Merkle tree of ``leaves`` (grp, digest, the columns ``order``, others)."""
    nodes, most = placed(leaves, order)
    rows, roots = grown(nodes, most)
    roots = materialize(roots, "subroots")
    # The groups' trees end in the leaves of one more tree, in the groups' order.
    over, groups = placed(roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), ["name"])
    over, top = grown(over, groups)
    top = top.first()  # one row
    over = over.select(F.col("name").alias("_name"), F.col("digest").alias("subroot"), F.col("path").alias("_above"))
    joined = rows.join(over, F.col("grp") == F.col("_name"))
    out = joined.select(*[c for c in rows.columns if c not in ("path", "block", "n")], "subroot", F.concat("path", "_above").alias("path"))
    return Manifest(out, None if top is None else top["digest"])


def documents_manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", values: tuple[str, ...] = VALUES, text: str = "text") -> Manifest:
    """The manifest of ``docs``, with the leaf that tampering gives (tampered, null where a row is not tampered with)."""
    at = [F.col(f"`{c}`") for c in values]
    changed = [F.translate(F.col(f"`{c}`"), UPPER, LOWER) if c == text else F.col(f"`{c}`") for c in values]
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % TAMPER == 0
    rows = docs.select(group_name(F.col(group)).alias("grp"), F.col(key).alias("key"), leaf(at).alias("digest"), F.when(chosen, leaf(changed)).alias("tampered"))
    return manifest(materialize(rows, "leaves"), ["key"])  # written: dealing by range reads it twice


def verified(made: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf of ``documents_manifest``."""
    root = F.lit(made.root).cast("string")
    folded = made.leaves.select(
        F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("path"), F.coalesce("tampered", "digest")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(docs: str, levels: int = 6) -> str:
    """Levels by plain grouping, and proofs by joining every node with its run; trees of up to 16**levels nodes."""
    blank = "coalesce({0}, '-')"
    value = lambda c: blank.format(f"strlen({c}::VARCHAR) || ':' || {c}::VARCHAR")
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    concat = lambda text: " || ".join(value(text if c == "text" else c) for c in VALUES)
    ctes = [
        "bits(t, c, k) AS (SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i) UNION ALL SELECT t, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8)",
        "crcs AS (SELECT list(c ORDER BY t) AS tab FROM bits WHERE k = 8)",
        f"d AS (SELECT row_number() OVER () AS r, source, doc_id, sha256({concat('text')}) AS leaf, sha256({concat(lower)}) AS other, "
        "doc_id IS NOT NULL AND xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), "
        f"lambda crc, b: xor(crc >> 8, tab[xor(crc, b) & 255 + 1]))) % {TAMPER} = 0 AS chosen FROM {docs}, crcs)".replace("xor(crc, b) & 255 + 1", "(xor(crc, b) & 255) + 1"),
        "n0 AS (SELECT r, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, leaf AS x FROM d)",
    ]

    def tree(prefix: str) -> None:
        for k in range(levels):
            digest = "CASE WHEN any_value(n) > 1 THEN sha256(string_agg(x, '' ORDER BY i)) ELSE any_value(x) END"
            ctes.append(f"{prefix}{k + 1} AS (SELECT g, i // 16 AS i, (any_value(n) + 15) // 16 AS n, {digest} AS x FROM {prefix}{k} GROUP BY g, i // 16)")
            ctes.append(
                f"s{prefix}{k} AS (SELECT a.g, a.i, coalesce(string_agg(b.x, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l, "
                f"coalesce(string_agg(b.x, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r, any_value(a.n) > 1 AS several "
                f"FROM {prefix}{k} a JOIN {prefix}{k} b ON a.g IS NOT DISTINCT FROM b.g AND a.i // 16 = b.i // 16 GROUP BY a.g, a.i)"
            )

    tree("n")
    ctes.append(f"m0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n, x, g AS name FROM n{levels})")
    tree("m")
    ctes.append(
        "w AS (SELECT d.r, d.doc_id, d.leaf, n0.i AS i, m0.i AS j, m0.x AS subroot, d.source, CASE WHEN chosen THEN other ELSE leaf END AS f, '' AS p "
        "FROM d JOIN n0 USING (r) JOIN m0 ON m0.name IS NOT DISTINCT FROM d.source)"
    )
    last = "w"
    for prefix, at, group in (("n", "i", "source"), ("m", "j", None)):
        for k in range(levels):
            on = f"s.i = w.{at} // {16**k}" + (f" AND s.g IS NOT DISTINCT FROM w.{group}" if group else "")
            now = f"w{prefix}{k}"
            ctes.append(f"{now} AS (SELECT w.* REPLACE (CASE WHEN several THEN sha256(s.l || f || s.r) ELSE f END AS f, CASE WHEN several THEN p || s.l || s.r ELSE p END AS p) FROM {last} w JOIN s{prefix}{k} s ON {on})")
            last = now
    return f"""
        WITH RECURSIVE {", ".join(ctes)}
        SELECT doc_id, leaf, subroot, m{levels}.x AS root, sha256(p) AS proof_sha256, f AS folded_root, f = m{levels}.x AS verified
        FROM {last}, m{levels}
    """
