"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from obsmatch.llm import op01_embeddings, op02_mixing, op03_decontamination, op04_language, op05_urls, op06_html, op07_token_files, op08_minhash, op09_chat, op10_sharding, op11_vector_codes, op12_lines, op13_merkle
from obsmatch.llm.common import configure, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@query("op1_embedding_near_duplicates", op01_embeddings.oracle("embeddings"))
def embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every vector."""
    return op01_embeddings.near_embeddings(table(spark, sf_dir, "embeddings"))


@query("op2_source_mixing", op02_mixing.oracle("documents"))
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to take, and how often, for three fifths of all tokens at the target weights."""
    docs = table(spark, sf_dir, "documents").withColumn("domain", op02_mixing.domain())
    return op02_mixing.mix(docs)


@query("op3_benchmark_decontamination", op03_decontamination.oracle("documents", "benchmark"))
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in occurrences of benchmark windows."""
    blocks = op03_decontamination.phrase_blocks(table(spark, sf_dir, "benchmark"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op03_decontamination.digest(op03_decontamination.decontaminate(docs, blocks))


@query("op4_language_identification")
def language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the labelled ones that are not held out."""
    return op04_language.language_query(table(spark, sf_dir, "documents"))


@query("op5_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    return op05_urls.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op6_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return op06_html.extract(table(spark, sf_dir, "pages"))


@query("op7_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and checksums of every document's token ids, read back from the token files."""
    return op07_token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_minhash_near_duplicates", op08_minhash.oracle("documents"))
def minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return op08_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("mark")


@query("op9_chat_formatting", op09_chat.oracle("conversations"))
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's turns and learned texts, read back from its token ids."""
    rows = table(spark, sf_dir, "conversations")
    return op09_chat.conversations_query(spark, rows, public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_extendible_sharding", op10_sharding.oracle("documents", op10_sharding.SHARD_BYTES))
def extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return op10_sharding.assign_shards(table(spark, sf_dir, "documents"))


@query("op11_vector_codes", op11_vector_codes.oracle("embeddings"))
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and error of every vector."""
    return op11_vector_codes.code_vectors(table(spark, sf_dir, "embeddings"))


@query("op12_line_dedup", op12_lines.oracle("documents"))
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, before and after those common to ten documents or more are dropped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op12_lines.digest(op12_lines.line_dedup(docs))


@query("op13_merkle_manifest", op13_merkle.oracle("documents"))
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its proof holds after tampering."""
    return op13_merkle.verified(op13_merkle.documents_manifest(table(spark, sf_dir, "documents")))
