import duckdb

import corpus_pipeline
from obsmatch.llm import op02_mixing, op03_decontamination, op10_sharding
from obsmatch.llm.common import materialize

SF = "/root/testdata/sf0.001"


def test_each_stage_on_what_the_one_before_kept(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(llm, before, SF), name)
        seen[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == before.columns
    before, after = seen["decontamination"]
    con = duckdb.connect()
    con.register("docs_", before.toPandas())
    con.execute(f"CREATE TABLE docs AS SELECT * FROM docs_; CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    clean = con.execute(f"SELECT doc_id FROM ({op03_decontamination.oracle('docs', 'benchmark')}) WHERE NOT contaminated").fetchall()
    assert sorted(r["doc_id"] for r in after.select("doc_id").collect()) == sorted(r[0] for r in clean) and len(clean) < before.count()
    con.register("left_", after.toPandas())
    con.execute("CREATE TABLE kept AS SELECT * FROM left_")
    mixed = seen["mixing"][1]
    copies = con.execute(f"SELECT sum(n_copies) FROM ({op02_mixing.oracle('kept')})").fetchall()[0][0]
    assert mixed.count() == copies
    con.register("mixed_", mixed.toPandas())
    con.execute("CREATE TABLE mixed AS SELECT * FROM mixed_")
    shards = con.execute(f"SELECT shard, count(*) FROM ({op10_sharding.oracle('mixed', op10_sharding.SHARD_BYTES)}) GROUP BY 1").fetchall()
    assert sorted((r["shard"], r["count"]) for r in docs.groupBy("shard").count().collect()) == sorted(shards)
    before, after = seen["near_dedup"]
    assert after.count() < before.count() and after.select("text").distinct().count() == after.count()


def test_clean_documents_pass_language_id_and_odd_rows_do_not_crash(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    odd = llm.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "src1", 0), (10**6, "", "en", "src1", 0), (10**6 + 1, "12 34", None, None, 5)], docs.schema)
    kept = corpus_pipeline.language_id(llm, docs.union(odd), SF)
    assert kept.count() == docs.count()
    for _, stage in corpus_pipeline.STAGES[1:]:
        stage(llm, docs.limit(30).union(odd), SF).collect()
        stage(llm, docs.limit(0), SF).collect()


def test_language_id_keeps_an_unlabelled_corpus(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").limit(30).selectExpr("doc_id", "text", "cast(null as string) as lang", "* except (doc_id, text, lang)")
    docs = docs.select(*llm.read.parquet(f"{SF}/documents.parquet").columns)
    odd = llm.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", None, None, 0), (10**6 + 2, "12 34!", None, None, 5), (10**6 + 3, "7 да", None, None, 5)], docs.schema)
    kept = corpus_pipeline.language_id(llm, docs.union(odd), SF).collect()
    assert len(kept) == docs.count() + 1 and all(r["lang"] is None for r in kept) and 10**6 + 3 in {r["doc_id"] for r in kept}
