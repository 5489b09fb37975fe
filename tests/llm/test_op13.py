import hashlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsmatch.llm import op13_merkle as merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, DIGEST string, pos string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """(root, proofs): runs of 16 until one node remains."""
    proofs = [""] * len(nodes)
    owner = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(owner):
            run = at // 16 * 16
            proofs[k] += "".join(nodes[j] for j in range(run, min(run + 16, len(nodes))) if j != at)
        nodes = [sha(*nodes[j : j + 16]) for j in range(0, len(nodes), 16)]
        owner = [at // 16 for at in owner]
    return nodes[0], proofs


def corpus(n):
    out = []
    for k in range(n):
        source = None if k % 50 == 0 else "" if k % 53 == 0 else "big" if k % 3 else f"s{'é' * (k % 2)}{k % 40}"
        out.append((None if k == 11 else (k * 7919) % 10007, source, None if k % 7 == 0 else "en", None if k % 5 == 0 else k, None if k % 13 == 0 else "Ab\nÇ" * (k % 9), "x", "y"))
    return out + [out[3]] * 40 + [(out[4][0], *out[5][1:])]


@pytest.mark.parametrize("bits, n", [(1, 700), (3, 300)])
def test_equals_sql(llm, duck, monkeypatch, bits, n):
    monkeypatch.setattr(merkle, "LEVELS", bits)  # more rounds of blocks on little data
    monkeypatch.setattr(merkle, "BLOCK_BITS", 4 * bits)
    data = corpus(n)
    made = merkle.documents_manifest(llm.createDataFrame(data, SCHEMA).repartition(5))
    got = merkle.verified(made)
    frame = pd.DataFrame([d[:5] for d in data], columns=["doc_id", "source", "lang", "n_chars", "text"]).astype({"doc_id": "Int64", "n_chars": "Int64"})
    assert sorted(repr(tuple(r)) for r in got.collect()) == duck(merkle.oracle("t", 4), t=frame)


@pytest.mark.parametrize("n", [1, 16, 17, 300])
def test_places_and_proofs(llm, n):
    digests = {k: sha(str(k)) for k in range(n)}
    rows = llm.createDataFrame([("g", digests[k], k) for k in range(n)], "grp string, digest string, key int").repartition(3)
    made = merkle.manifest(rows, ["key"])
    root, proofs = climb([digests[k] for k in range(n)])
    assert made.root == root
    got = made.leaves.select("key", "pos", merkle.proof_digest(F.col("path")).alias("p"), merkle.fold(F.col("path"), F.col("digest")).alias("f")).collect()
    assert {(r["key"], r["pos"], r["p"], r["f"]) for r in got} == {(k, k, sha(proofs[k]), root) for k in range(n)}


def test_one_row_repeated_is_spread(llm):
    """Equal rows are leaves of their own and do not gather in one range."""
    rows = llm.range(0, 40_000, 1, 6).select(F.lit("g").alias("grp"), F.lit(sha("a")).alias("digest"), F.lit(1).alias("key"))
    nodes, most = merkle.placed(rows, ["key"])
    assert most == 40_000 and nodes.agg(F.count_distinct("pos"), F.max("pos")).first()[:] == (40_000, 39_999)
    root, _ = climb([sha("a")] * 40_000)
    assert merkle.manifest(rows, ["key"]).root == root


def test_no_rows(llm):
    made = merkle.documents_manifest(llm.createDataFrame([], SCHEMA))
    assert made.root is None and merkle.verified(made).collect() == []
