import pandas as pd
import pytest

from obsmatch.llm import op02_mixing as mixing
from obsmatch.llm import op10_sharding as sharding

SCHEMA = "doc_id bigint, text string, lang string, source string, n_tokens int, quota int"


def corpus(n=400):
    out = []
    for k in range(n):
        source = None if k % 41 == 0 else "odd" if k % 37 == 0 else f"src{k % 3 if k % 2 else k % 17}"
        lang = (None, "en", "de", "fr", "es")[0 if k % 29 == 0 else 1 + (k * k) % 4]
        text = None if k % 23 == 0 else "" if k % 19 == 0 else "  \n" if k % 31 == 0 else "w " * (1 + (k * 7919) % 97)
        out.append((None if k == 7 else k, text, lang, source, 1, 1))
    return out + [out[50]] * 5 + [out[51]] * 150 + [(None, "null id again", "en", "src1", 1, 1)]


def frame(data):
    out = pd.DataFrame([r[:4] for r in data], columns=["doc_id", "text", "lang", "source"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


@pytest.mark.parametrize("share", [(3, 5), (1, 50), (7, 2), (50, 1)])
def test_mixture_equals_plain_sums(llm, duck, monkeypatch, share):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 8)
    data = corpus()
    docs = llm.createDataFrame(data, SCHEMA).withColumn("domain", mixing.domain())
    chosen = mixing.mix(docs, share=share)
    columns = ["doc_id", "domain", "lang", "source", "n_tokens", "n_copies"]
    got = sorted(repr(tuple(r)) for r in chosen.select(*columns).collect())
    assert got == duck(f"SELECT {', '.join(columns)} FROM ({mixing.oracle('docs', share)})", docs=frame(data))
    copies = mixing.apply_mix(docs, chosen)
    assert copies.columns == docs.columns
    total = chosen.groupBy().sum("n_copies").first()[0] or 0
    assert copies.count() == total


def test_shortage_goes_to_siblings_first(llm):
    # en has 10 tokens at most; de takes its part before the other domain gets more.
    data = [(1, "a " * 10, "en", "s1"), (2, "b " * 100, "de", "s2"), (3, "c " * 100, "en", "s3")]
    docs = llm.createDataFrame(data, "doc_id long, text string, lang string, domain string").withColumnRenamed("domain", "source").selectExpr("*", "if(doc_id < 3, 'web', 'forum') AS domain")
    leaves = docs.selectExpr("domain", "lang", "source", "size(split(trim(text), ' ')) AS tokens")
    weights = {"domain": {"web": 1, "forum": 1}, "lang": {"en": 1, "de": 1}}
    got = {r["source"]: r["quota"] for r in mixing.leaf_budgets(leaves, 100, weights, mixing.LEVELS, 1).collect()}
    assert got == {"s1": 10, "s2": 40, "s3": 50}
    got = {r["source"]: r["quota"] for r in mixing.leaf_budgets(leaves, 190, weights, mixing.LEVELS, 1).collect()}
    assert got == {"s1": 10, "s2": 85, "s3": 95}


def test_empty_mixture(llm):
    docs = llm.createDataFrame([], SCHEMA).withColumn("domain", mixing.domain())
    assert mixing.mix(docs).collect() == []


@pytest.mark.parametrize("limit", [1, 60, 500, 10**9])
def test_shards_equal_all_prefixes(llm, duck, monkeypatch, limit):
    monkeypatch.setattr(sharding, "SPARE_BITS", 1)
    data = corpus() + [(9, "x" * 2000, None, None, 1, 1)]
    got = sharding.assign_shards(llm.createDataFrame(data, SCHEMA), limit).collect()
    columns = ["doc_id", "copy", "n_bytes", "depth", "prefix", "shard"]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got) == duck(f"SELECT {', '.join(columns)} FROM ({sharding.oracle('docs', limit)})", docs=frame(data))
    assert len(got) == len(data)
    size = pd.DataFrame([r.asDict() for r in got]).groupby("shard").n_bytes.agg(["sum", "count"])
    assert ((size["sum"] <= limit) | (size["count"] == 1)).all()


def test_no_rows_to_shard(llm):
    assert sharding.assign_shards(llm.createDataFrame([], SCHEMA), 10).collect() == []


def test_one_key_with_a_third_of_all_rows_is_split(llm):
    data = [(5, "same text")] * 300 + [(k, "other") for k in range(600)]
    got = sharding.assign_shards(llm.createDataFrame(data, "doc_id long, text string"), 200)
    assert got.count() == 900 and got.groupBy("shard").sum("n_bytes").agg({"sum(n_bytes)": "max"}).first()[0] <= 200


def test_native_plans(llm):
    docs = llm.createDataFrame(corpus(), SCHEMA)
    plan = sharding.assign_shards(docs, 100)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
