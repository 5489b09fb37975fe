"""A corpus pipeline of five stages, each one of the operators in ``obsmatch.llm``.

Every stage takes what its predecessor kept, written as Parquet and read again; all but the last return the columns of
``documents``. Nothing here swallows import errors: without the ``llm`` subpackage this module cannot be imported.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.llm import op02_mixing, op03_decontamination, op04_language, op08_minhash, op10_sharding
from obsmatch.llm.common import configure, materialize, settle, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (``und``); ``lang`` becomes the predicted one.

    Where no language can be learned, only texts that are null or have no letter go, and ``lang`` stays as it is."""
    configure(spark)
    settle(spark)
    model = op04_language.learn(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = op04_language.identify(docs, model)
    kept = found.where(F.col("lang_pred") != op04_language.UNDETERMINED).withColumn("lang", F.col("lang_pred"))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class: the one with the smallest id.

    Rows equal in id and text are one document; different texts of one id are judged each on its own."""
    configure(spark)
    settle(spark)
    return op08_minhash.keep_one(docs).select(*[f"`{c}`" for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    configure(spark)
    settle(spark)
    blocks = op03_decontamination.phrase_blocks(table(spark, sf_dir, "benchmark"))
    found = op03_decontamination.decontaminate(docs, blocks)
    return found.where("n_hit = 0").select(*[f"`{c}`" for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mixture's proportions, each as often as its epochs have it."""
    configure(spark)
    settle(spark)
    chosen = materialize(op02_mixing.mix(docs.withColumn("domain", op02_mixing.domain())), "mixture")
    mixed = op02_mixing.apply_mix(docs.withColumn("domain", op02_mixing.domain()), chosen)
    return mixed.select(*[f"`{c}`" for c in docs.columns])


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of every row."""
    configure(spark)
    return op10_sharding.assign_shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Language identification and near-duplicate classes have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
