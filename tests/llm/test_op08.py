import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from obsmatch.llm import components as graph
from obsmatch.llm import op08_minhash as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, rid int, bucket string"


def brute(data):
    bags, ids = [], []
    for key, text, *_ in data:
        w = WORD.findall((text or "").lower())
        bags.append(Counter(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else Counter())
        ids.append(key)
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if bags[a] and bags[b] and ids[a] is not None and ids[b] is not None:
                common = sum((bags[a] & bags[b]).values())
                if 5 * common >= 4 * sum((bags[a] | bags[b]).values()):
                    root[find(a)] = find(b)
    first = {}
    marks = [hashlib.md5(r[1].encode()).hexdigest() if r[1] is not None else "" for r in data]
    for k, key in enumerate(ids):
        if key is not None:
            first[find(k)] = min(first.get(find(k), (key, marks[k])), (key, marks[k]))
    return sorted(repr((key, None if key is None else first[find(k)][0], key is None or first[find(k)] == (key, marks[k]))) for k, key in enumerate(ids))


def corpus():
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(8, 120))) for _ in range(12)]
    texts = [None, "", "!!", "one two", "One, TWO.", "a b a b a b a b a b", "a b a b a b a b"]
    for b in base:
        words = b.split()
        for _ in range(rng.randrange(1, 15)):
            w = list(words)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
            texts.append(" ".join(w))
        texts.append(b)
    texts.append("long " + " ".join(f"v{k % 977}" for k in range(20_000)))
    texts.append("tall " + " ".join(f"v{k % 977}" for k in range(20_000)))
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(o, t, 1, "x") for o, t in zip(order, texts)]


@pytest.mark.parametrize("chunk,runs", [(256, 200_000), (3, 200)])
def test_classes_equal_brute_force(llm, monkeypatch, chunk, runs):
    monkeypatch.setattr(op, "CHUNK", chunk)
    monkeypatch.setattr(op, "CHUNK_RUNS", runs)
    data = corpus() + [(None, "one two", 1, "x")]
    got = op.near_duplicates(llm.createDataFrame(data, SCHEMA)).drop("mark")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(data)


def test_repeated_and_no_rows(llm):
    data = [(1, "same words here and there", 1, ""), (1, "same words here and there", 1, ""), (2, "same words here and there", 1, "")]
    got = sorted(tuple(r) for r in op.near_duplicates(llm.createDataFrame(data, SCHEMA)).drop("mark").collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False)]
    assert op.near_duplicates(llm.createDataFrame([], SCHEMA)).collect() == []


ALPHA, BETA, GAMMA = (" ".join(f"{name}{k}" for k in range(30)) for name in ("alpha", "beta", "gamma"))


@pytest.mark.parametrize(
    "rows, kept",
    [
        ([(1, ALPHA), (1, BETA), (2, BETA), (3, GAMMA)], [(1, ALPHA), (1, BETA), (3, GAMMA)]),
        ([(5, ALPHA), (5, GAMMA)], [(5, ALPHA), (5, GAMMA)]),
        ([(5, ALPHA), (5, ALPHA), (5, ALPHA + " end"), (4, BETA), (6, BETA)], None),
        ([(7, None), (7, ""), (7, "!!"), (8, None), (None, ALPHA), (None, ALPHA), (9, ALPHA)], None),
        ([(k % 3, f"{ALPHA} {k % 7}") for k in range(40)] + [(k % 5, f"{BETA} x{k}") for k in range(40)], None),
    ],
)
def test_ids_with_several_texts_lose_none(llm, duck, rows, kept):
    data = [(i, t, 1, "x") for i, t in rows]
    docs = llm.createDataFrame(data, SCHEMA)
    got = sorted(repr(tuple(r)) for r in op.near_duplicates(docs).drop("mark").collect())
    assert got == brute(data)
    frame = pd.DataFrame({"doc_id": pd.array([d[0] for d in data], "Int64"), "text": [d[1] for d in data]})
    assert got == duck(op.oracle("t"), t=frame)
    one = sorted(((r["doc_id"], r["text"]) for r in op.keep_one(docs).collect()), key=repr)
    if kept is not None:
        assert one == sorted(kept, key=repr)
    # Every row is near one that stays: its own text, or its component's keeper; no row stays twice.
    assert len([r for r in one if r[0] is not None]) == len({r for r in one if r[0] is not None})
    assert len([r for r in one if r[0] is None]) == len([r for r in rows if r[0] is None])
    assert {(i, t) for i, t in one} == {(i, t) for (i, t), r in zip(rows, _flags(op.near_duplicates(docs), rows), strict=True) if r}


def _flags(found, rows):
    kept = {(r["doc_id"], r["mark"]): r["kept"] for r in found.collect()}
    return [kept[i, hashlib.md5(t.encode()).hexdigest() if t is not None else ""] for i, t in rows]


def test_components_of_any_graph(llm, monkeypatch):
    monkeypatch.setattr(graph, "EDGES", 7)
    rng = random.Random(4)
    path = [(k, k + 1) for k in range(0, 60)]
    star = [(1000, 1001 + k) for k in range(50)]
    loose = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = path + star + loose + [(5, 5), (5, 6), (6, 5)]
    rng.shuffle(edges)
    got = {(r["node"], r["component"]) for r in graph.components(llm.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()}
    least = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(len(least)):
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert got == set(least.items())
    assert graph.components(llm.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**63, 60).astype(np.uint64)
    a, b = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
    size = 20_000
    both = [op.bag_minhash(x[c > 0], c[c > 0], np.zeros((c > 0).sum(), np.int64), 1, size)[0] for c in (a, b)]
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((both[0] == both[1]).mean() - expected) < 0.015
