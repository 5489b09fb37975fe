import pandas as pd
import pyarrow as pa

from obsmatch.llm import op03_decontamination as op
from obsmatch.llm.common import text_buffers

SCHEMA = "doc_id bigint, text string, item_ids string, Text2 int"
WORDS = [f"w{k}é" for k in range(60)]


def corpus():
    long = " ".join(WORDS[k * k % 60] for k in range(5000))
    docs = [None, "", "...", "W0É w1é", " ".join(WORDS[:12]), " ".join(WORDS[3:40]) + " " + " ".join(WORDS[5:20]), long, "x " + " ".join(WORDS[:10]).upper().replace("É", "é") + " y", "short item", "a short item b", "short", " ".join(["q"] * 30)]
    docs += [docs[5]] * 3
    items = [(1, " ".join(WORDS[:15])), (2, " ".join(WORDS[10:31])), (3, "Short, ITEM!"), (4, None), (5, ""), (10, " ".join(WORDS[:15])), (6, " ".join(["q"] * 12)), (7, long)]
    return [(k, t, "clash", 1) for k, t in enumerate(docs)], items


def digest(llm, docs, items, **options):
    d = llm.createDataFrame(docs, SCHEMA)
    b = llm.createDataFrame(items, "item_id bigint, text string")
    return op.digest(op.decontaminate(d, op.phrase_blocks(b, **options)))


def test_equals_sql_for_any_number_of_blocks(llm, duck):
    docs, items = corpus()
    frames = {"docs": pd.DataFrame([r[:2] for r in docs], columns=["doc_id", "text"]), "bench": pd.DataFrame(items, columns=["item_id", "text"])}
    columns = "doc_id, n_words, n_hit, n_items, items_sha256, contaminated"
    expected = duck(f"SELECT {columns} FROM ({op.oracle('docs', 'bench')})", **frames)
    for options in ({}, {"block_words": 10}):
        got = digest(llm, docs, items, **options)
        assert sorted(repr(tuple(r)) for r in got.select(*columns.split(", ")).collect()) == expected


def test_spans_are_merged_and_stay_in_their_document(llm):
    docs, items = corpus()
    d = llm.createDataFrame(docs, SCHEMA)
    got = {r["doc_id"]: r for r in op.decontaminate(d, op.phrase_blocks(llm.createDataFrame(items, "item_id bigint, text string"))).collect()}
    assert [tuple(s) for s in got[4]["hit_spans"]] == [(0, 12)]
    assert [tuple(s) for s in got[11]["hit_spans"]] == [(0, 30)]
    assert got[9]["item_ids"] == ["3"] and got[0]["hit_spans"] == [] and set(got[4].asDict()) == {"doc_id", "text", "Text2", "n_words", "n_hit", "item_ids", "hit_spans"}


def test_empty_tables(llm):
    docs, items = corpus()
    assert digest(llm, [], items).collect() == []
    assert {r["n_hit"] for r in digest(llm, docs, []).collect()} == {0}
    assert digest(llm, docs, [(None, "short item")]).where("contaminated").count() == 2


def test_a_common_word_in_many_equal_items_takes_no_more_memory():
    import tracemalloc

    data, offsets = text_buffers(pa.array(["the " * 50_000, "a the b", "", "none"], pa.string()))

    def peak(items):
        p = op.phrases([f"i{k}" for k in range(items)], ["the"] * items)
        tracemalloc.start()
        at, start, end, doc, item = op.search_slice(data, offsets, p)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(start) == 50_001 and (end - start == 1).all()
        assert sorted(zip(doc.tolist(), item.tolist())) == [(d, i) for d in (0, 1) for i in range(items)]
        return most

    peak(2)  # tables that are built once
    assert peak(1_000) < 1.2 * peak(1)
