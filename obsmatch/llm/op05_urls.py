"""URL filters: rules first, and a tree of path templates for each host for all other URLs.

A URL's host is what stands after its first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; its path goes on to
``?``, ``#`` or the end. A rule (host, path) fits its host and all subdomains if the path starts with the rule's;
the longest rule that fits decides.

The tree has the path's segments as levels, down to the deepest. Level by level and host by host,
1. a segment that looks like a value (a number, a date, a long hexadecimal or mixed token) becomes a typed wildcard;
2. branches without labels, and those whose labelled purity does not differ from their siblings' (two proportions, ``Z``),
   merge into ``*``; neither their size nor their number merges them.
The template of a URL is its path of generalised segments; those below ``LEVELS`` are written ``#`` by ``#`` behind the
last ``/`` (no path has a ``#``). Its purity is the good share of its labelled pages,
smoothed towards its host's, which is smoothed towards the corpus's; a template below ``MIN_PURITY`` is blocked.

Everything is counted over distinct (host, path shape) rows with their numbers of pages, so a host with a third of
all pages is no larger than its number of different paths; counts combine before they are shuffled.

Defined cases: a null URL, or one without ``://``, has an empty host and path and is judged like any other; a page
without a label only takes part in row counts; pages of one id each count; an id with several labels counts as bad if one
is; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmatch.llm.common import materialize

#: (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Levels that a template writes with ``/``; below them all rows of a node go on to where they part in one step.
LEVELS = 6
Z = 1.96
#: Pages that a prior weighs as much as.
PRIOR = 5.0
MIN_PURITY = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3, F.length(url))
    some = url.isNotNull() & (at > 0)
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(some, host).otherwise(""), F.when(some, path).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest fitting rule, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):  # the last that fits wins
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, h + p).otherwise(name)
        verdict = F.when(fits, v).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    """The path's segments with values replaced by typed wildcards."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")

    def kind(s: Column) -> Column:
        return (
            F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "{date}")
            .when(s.rlike(r"^[0-9]+(\.[a-z]{2,5})?$"), F.regexp_replace(s, "^[0-9]+", "{n}"))
            .when(s.rlike(r"^[0-9a-fA-F-]{16,}$"), "{hex}")
            .when(s.rlike(r"[0-9].*[0-9].*[0-9]"), "{id}")
            .otherwise(s)
        )

    return F.transform(parts, kind)


def _skip(rows: DataFrame) -> DataFrame:
    """``rows`` with the segments that all unfinished rows of a node share moved from ``rest`` to ``template``."""
    node = rows.groupBy("host", "template").agg(F.min("rest").alias("lo"), F.max("rest").alias("hi"))
    parts = F.array_position(F.transform(F.arrays_zip("lo", "hi"), lambda z: z["lo"].eqNullSafe(z["hi"])), False)
    shared = node.select("host", "template", F.when(parts > 0, parts - 1).otherwise(F.size("lo")).cast("int").alias("shared"))
    first = F.transform(F.slice("rest", 1, F.col("shared")), lambda s: F.concat(F.lit("#"), s))
    more = F.slice("rest", F.col("shared") + 1, F.size("rest"))
    return rows.join(shared, ["host", "template"]).withColumn("template", F.concat("template", F.array_join(first, ""))).withColumn("rest", more).drop("shared")


def templates(shapes: DataFrame) -> DataFrame:
    """``shapes`` (host, shape, n, labelled, good) with ``template``."""
    columns = ["host", "shape", "n", "labelled", "good", "template"]
    rows = materialize(shapes.withColumn("template", F.lit("")).withColumn("rest", F.col("shape")), "shapes")
    finished: list[DataFrame] = []
    level = 0
    while True:
        finished.append(rows.where(F.size("rest") == 0).select(*columns))
        here = rows.where(F.size("rest") > 0)
        if here.isEmpty():
            break
        level += 1
        if level == LEVELS + 1:
            here = here.withColumn("template", F.concat("template", F.lit("/")))
        if level > LEVELS:
            here = materialize(_skip(here), "skipped")
            finished.append(here.where(F.size("rest") == 0).select(*columns))
            here = here.where(F.size("rest") > 0)
        here = here.withColumn("child", F.element_at("rest", 1))
        sums = [F.sum(c).alias(c) for c in ("labelled", "good")]
        child = here.groupBy("host", "template", "child").agg(*sums)
        node = child.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kinds"), *[F.sum(c).alias(f"all_{c}") for c in ("labelled", "good")])
        child = child.join(node, ["host", "template"])
        others, others_good = F.col("all_labelled") - F.col("labelled"), F.col("all_good") - F.col("good")
        rate = F.col("all_good") / F.col("all_labelled")
        spread = F.sqrt(rate * (1 - rate) * (1 / F.col("labelled") + 1 / others))
        apart = F.abs(F.col("good") / F.col("labelled") - others_good / others)
        # Without labels on either side there is nothing that tells the branches apart.
        alike = F.when((F.col("labelled") > 0) & (others > 0), apart <= Z * spread).otherwise(F.lit(True))
        merged = F.when((F.col("kinds") > 1) & alike, "*").otherwise(F.col("child"))
        names = child.select("host", "template", "child", merged.alias("branch"))
        names = names.toDF("host_", "template_", "child_", "branch")
        same = (F.col("host") == F.col("host_")) & (F.col("template") == F.col("template_")) & (F.col("child") == F.col("child_"))
        longer = F.concat("template", F.lit("/" if level <= LEVELS else "#"), "branch").alias("template")
        step = here.join(names, same).select(*columns[:-1], longer, F.slice("rest", 2, F.size("rest")).alias("rest"))
        rows = materialize(step, "templates")
    return reduce(DataFrame.unionByName, finished)


def verdicts(rows: DataFrame) -> DataFrame:
    """(host, shape, template, purity, verdict)."""
    total = rows.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("corpus_good"), F.coalesce(F.sum("labelled"), F.lit(0)).alias("corpus_labelled"))
    host = rows.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("labelled").alias("host_labelled"))
    each = rows.groupBy("host", "template").agg(F.sum("good").alias("t_good"), F.sum("labelled").alias("t_labelled"))
    corpus = (F.col("corpus_good") + 1.0) / (F.col("corpus_labelled") + 1.0)  # without labels everything is taken for good
    of_host = (F.col("host_good") + PRIOR * corpus) / (F.col("host_labelled") + PRIOR)
    purity = (F.col("t_good") + PRIOR * of_host) / (F.col("t_labelled") + PRIOR)
    # ``total`` is one row.
    each = each.join(host, "host").join(F.broadcast(total), F.lit(True))
    judged = each.select("host", "template", purity.alias("purity"), F.when(purity < MIN_PURITY, "block").otherwise("allow").alias("method"))
    return rows.select("host", "shape", "template").join(judged, ["host", "template"])


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, template, purity) of every page.

    ``labels`` has (doc_id, quality, toxic) of the documents that the pages of the same ids became; good is quality 1
    and not toxic.
    """
    host, path = host_and_path(F.col("_url"))
    rows = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url")).select("_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("shape", shape(F.col("path")))
    good = F.coalesce(F.col("quality") == 1, F.lit(False)) & ~F.coalesce(F.col("toxic") == 1, F.lit(False))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(good.cast("long")).alias("ok"))
    counted = rows.join(marks, F.col("_id") == F.col("doc_id"), "left")
    shapes = counted.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("ok").alias("labelled"), F.coalesce(F.sum("ok"), F.lit(0)).alias("good"))
    judged = materialize(verdicts(templates(shapes)), "judged")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = rows.join(judged, ["host", "shape"]).withColumn("rule", name).withColumn("verdict", F.coalesce(verdict, F.col("method")))
    return out.select(F.col("_id").alias(key), "host", "path", "rule", "verdict", "template", "purity")
