"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

The token budget goes down a tree of levels (domain, language, source). At each node the children share it by
their weights, and none gets more than its own leaves can give in ``max_epochs`` passes: what a child cannot
take goes to its siblings by their weights, and only what all of them together cannot take stays with the parent,
whose capacity was counted the same way one level up. So a shortage is met by siblings before ancestors.
Shares are whole tokens, rounded down.

A leaf with tokens t and budget q is passed over q div t times whole; the rest is the longest prefix of whole
documents, in the seeded order of the next epoch, whose tokens fit. The order is a hash, so the prefix is found
from sums of hash ranges first, and rows are only sorted inside the one range where a leaf's budget ends.

Defined cases: a document without tokens (null, empty, only white space) is never selected; a null level value is
a node of its own, named ``null``; repeated rows share one place in the order and are taken or left together;
null keys hash as their own value; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from obsmatch.llm.common import materialize

LEVELS = ("domain", "lang", "source")
#: Bytes that separate tokens.
TOKEN = r"[^ \t\n\r\f]+"
HASH_BITS = 60
#: Rows that a hash range has about.
RANGE_ROWS = 4096

#: Production parameters of the registered query: the share of all tokens to select, passes over a leaf, weights.
SHARE = (3, 5)
MAX_EPOCHS = 4
SEED = 17
WEIGHTS = {"domain": {"web": 5, "forum": 3, "reference": 2}, "lang": {"en": 4, "de": 2, "es": 2, "fr": 2}, "source": {}}
#: Sources by their number: below 8, below 14, the rest.
DOMAIN_SQL = """CASE WHEN source IS NULL OR NOT {like} THEN 'other' WHEN {number} < 8 THEN 'web'
 WHEN {number} < 14 THEN 'forum' ELSE 'reference' END"""


def domain() -> Column:
    """The domain of a source named ``src`` and a number; every other source is in ``other``."""
    return F.expr(DOMAIN_SQL.format(like=r"source RLIKE '^src[0-9]{1,9}$'", number="try_cast(substr(source, 4) AS INT)"))


def _name(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    known = weights.get(level, {})
    out = F.lit(1)
    for name, weight in known.items():
        out = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def leaf_budgets(leaves: DataFrame, budget: int, weights: Mapping[str, Mapping[str, int]], levels: Sequence[str], max_epochs: int) -> DataFrame:
    """``leaves`` (levels, tokens) with ``quota``, the tokens each one gives.

    The table has a row for each leaf; its windows run over the children of one node.
    """
    big = "decimal(38,0)"
    share = None
    for k, level in enumerate(levels):
        path, parent = list(levels[: k + 1]), list(levels[:k])
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).cast("long").alias("cap")).withColumn("w", _weight(level, weights)).where("w > 0")
        nodes = nodes.withColumn("given", F.lit(int(budget)).cast("long")) if share is None else nodes.join(share.select(*parent, F.col("quota").alias("given")), parent)
        by = W.partitionBy(*(parent or [F.lit(0)]))
        order = by.orderBy((F.col("cap") / F.col("w")).cast("double"), F.col(level))
        before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.currentRow, W.unboundedFollowing)
        nodes = nodes.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("w_after", F.sum("w").over(after))
        nodes = nodes.withColumn("full", F.col("cap").cast(big) * F.col("w_after") <= F.col("w").cast(big) * (F.col("given") - F.col("cap_before")))
        taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(by), F.lit(0))
        open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(by)
        nodes = nodes.withColumn("rest", F.col("given") - taken).withColumn("open_w", open_w)
        part = F.expr(f"cast(cast(w AS {big}) * rest div open_w AS bigint)")
        share = nodes.select(*path, F.when(F.col("full"), F.col("cap")).otherwise(part).alias("quota"))
    return leaves.join(share, list(levels))


def counted(docs: DataFrame, levels: Sequence[str] = LEVELS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, levels, n_tokens) of the documents with tokens."""
    return docs.select(F.col(key), *[_name(c).alias(c) for c in levels], F.regexp_count(F.col(text), F.lit(TOKEN)).cast("long").alias("n_tokens")).where("n_tokens > 0")


def mix(
    docs: DataFrame,
    share: tuple[int, int] = SHARE,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    levels: Sequence[str] = LEVELS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    budget: int | None = None,
) -> DataFrame:
    """(key, levels, n_tokens, n_copies) of each selected row; ``n_copies`` is how many epochs have it.

    ``budget`` in tokens, or else ``share`` (numerator, denominator) of all tokens.
    """
    levels = list(levels)
    rows = materialize(counted(docs, levels, key, text), "tokens")
    leaves = materialize(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "leaves")
    total, n = leaves.agg(F.sum("tokens"), F.sum("n")).first()
    if budget is None:
        budget = int(total or 0) * share[0] // share[1]
    bits = min(30, (int(n or 0) // RANGE_ROWS).bit_length())
    plan = leaf_budgets(leaves.select(*levels, "tokens"), budget, weights, levels, max_epochs)
    plan = materialize(plan.selectExpr(*levels, "quota div tokens AS whole", "quota % tokens AS rest"), "plan")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    placed = rows.join(plan, levels).withColumn("h", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    placed = placed.withColumn("part", F.shiftright("h", HASH_BITS - bits))
    sums = placed.groupBy(*levels, "part").agg(F.sum("n_tokens").alias("part_tokens"), F.first("rest").alias("rest"))
    along = W.partitionBy(*levels).orderBy("part").rowsBetween(W.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("part_tokens").over(along)).withColumn("before", F.col("upto") - F.col("part_tokens"))
    # A range inside the budget is taken whole; the first that is not inside is looked at row by row.
    edges = sums.where("before <= rest").select(*levels, "part", "before", (F.col("upto") <= F.col("rest")).alias("inside"))
    placed = placed.join(edges, [*levels, "part"], "left")
    # Equal rows meet as one row and a count first: however often a key is repeated, it is one row of the window.
    cut = placed.where("not inside").groupBy(*placed.columns).agg(F.count(F.lit(1)).alias("rows"))
    within = W.partitionBy(*levels, "part").orderBy("h", key)  # rows of one place share a sum
    upto = F.col("before") + F.sum(F.col("n_tokens") * F.col("rows")).over(within)
    cut = cut.withColumn("extra", (upto <= F.col("rest")).cast("int"))
    cut = cut.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows", "copy")
    whole = placed.where("inside is null or inside").withColumn("extra", F.when(F.col("inside"), 1).otherwise(0))
    out = whole.unionByName(cut).withColumn("n_copies", F.col("whole") + F.col("extra"))
    return out.where("n_copies > 0").select(key, *levels, "n_tokens", "n_copies")


def apply_mix(docs: DataFrame, chosen: DataFrame, levels: Sequence[str] = LEVELS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The selected rows of ``docs`` themselves, each as often as its epochs have it."""
    columns = [f"`{c}`" for c in docs.columns]
    names = {"_key": F.col(key), **{f"_{c}": _name(c) for c in levels}, "_n_tokens": F.regexp_count(F.col(text), F.lit(TOKEN)).cast("long")}
    left = docs.withColumns(names)
    right = chosen.select(F.col(key).alias("_key2"), *[F.col(c).alias(f"_{c}") for c in levels], F.col("n_tokens").alias("_n_tokens"), "n_copies").distinct()
    same = left["_key"].eqNullSafe(right["_key2"])
    for c in [f"_{c}" for c in levels] + ["_n_tokens"]:
        same = same & (left[c] == right[c])
    return left.join(right, same).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies")))).select(*columns)


def oracle(relation: str, share: tuple[int, int] = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for ``mix`` with the production weights: direct cumulative sums, no hash ranges."""

    def weight(level: str) -> str:
        known = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
        return f"(CASE {level} {known} ELSE 1 END)::BIGINT" if known else "1::BIGINT"

    parts, parent = [], []
    for k, level in enumerate(LEVELS):
        path = ", ".join(LEVELS[: k + 1])
        given = "(SELECT sum(tokens) * {} // {} FROM leaves)::BIGINT".format(*share) if not k else f"s{k - 1}.quota"
        source = f"FROM leaves GROUP BY {path}"
        by = "PARTITION BY " + ", ".join(f"n.{p}" for p in parent) if parent else ""
        join = f"JOIN s{k - 1} USING ({', '.join(parent)})" if parent else ""
        parts.append(f"""
n{k} AS (SELECT {path}, (sum(tokens) * {max_epochs})::BIGINT AS cap, {weight(level)} AS w {source}),
o{k} AS (
  SELECT n.*, {given} AS given,
    coalesce(sum(cap) OVER ({by} ORDER BY cap::DOUBLE / w::DOUBLE, n.{level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    sum(w) OVER ({by} ORDER BY cap::DOUBLE / w::DOUBLE, n.{level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_after
  FROM n{k} n {join}
),
f{k} AS (SELECT *, cap::HUGEINT * w_after <= w::HUGEINT * (given - cap_before) AS is_full FROM o{k}),
s{k} AS (
  SELECT {path}, CASE WHEN is_full THEN cap
    ELSE w * (given - coalesce(sum(cap) FILTER (is_full) OVER ({by.replace('n.', '')}), 0)) // sum(w) FILTER (NOT is_full) OVER ({by.replace('n.', '')}) END::BIGINT AS quota
  FROM f{k}
)""")
        parent.append(level)
    domain_sql = DOMAIN_SQL.format(like="regexp_full_match(source, 'src[0-9]{1,9}')", number="try_cast(substr(source, 4) AS INT)")
    return f"""
WITH d AS (
  SELECT doc_id, {domain_sql} AS domain, coalesce(lang, 'null') AS lang, coalesce(source, 'null') AS source,
         len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+'))::BIGINT AS n_tokens
  FROM {relation}
), rows_ AS (SELECT * FROM d WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM rows_ GROUP BY ALL),
{",".join(parts)},
plan AS (SELECT l.*, quota // tokens AS whole, quota % tokens AS rest FROM leaves l JOIN s2 USING (domain, lang, source)),
placed AS (
  SELECT r.*, whole, rest, ('0x' || substr(md5('{seed}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
  FROM rows_ r JOIN plan USING (domain, lang, source)
), summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id) AS upto FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS n_copies
FROM summed WHERE whole > 0 OR upto <= rest"""
