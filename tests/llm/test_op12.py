import hashlib
import random

import pandas as pd
import pytest

from obsmatch.llm import op12_lines as lines

SCHEMA = "doc_id bigint, text string, N_LINES string, source string"
COMMON = ["  Share this\t", "SHARE this", "share THIS \r", "\x0bprivacy policy\x0c", "Ünï cookies", "x"]


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        parts = [f"line {rng.randrange(10**6)} of {k}" for _ in range(rng.randrange(6))]
        parts += rng.sample(COMMON, rng.randrange(4)) + [f"rare {k % 60}"] * (k % 3) + ["", " \t "] * (k % 2)
        rng.shuffle(parts)
        out.append((k, "\n".join(parts), "clash", "s"))
    out += [(1000, None, None, None), (1001, "", None, None), (1002, "\n\n", None, None), (None, "x\nshare this", None, None), (None, "only", None, None)]
    return out + [(5000, "copied\nrow", None, None)] * 9 + [(5001, "nine only", None, None)] * 9 + [(5002, "Copied ", None, None)]


def frame(data):
    return pd.DataFrame({"doc_id": pd.array([d[0] for d in data], "Int64"), "text": [d[1] for d in data]})


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_equals_sql_both_ways(llm, duck, broadcast):
    data = corpus()
    docs = llm.createDataFrame(data, SCHEMA).repartition(5)
    got = lines.line_dedup(docs, broadcast_bytes=broadcast)
    assert set(got.columns) == {"doc_id", "text", "source", "n_lines", "n_dropped"}
    assert sorted(repr(tuple(r)) for r in lines.digest(got).collect()) == duck(lines.oracle("t"), t=frame(data))
    assert got.where("doc_id = 1000 and text is null and n_lines = 1").count() == 1


def plain(data, min_docs, min_chars, first):
    key = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(" \t\n\x0b\x0c\r"))
    met, least = {}, {}
    for r, (i, text, *_) in enumerate(data):
        for j, part in enumerate((text or "").split("\n")):
            k = key(part)
            if len(k) >= min_chars:
                met.setdefault(k, set()).add(r)
                at = (i is not None, i or 0, j)
                least[k] = min(least.get(k, at), at)
    common = {k for k, rows in met.items() if len(rows) >= min_docs}
    out = []
    for i, text, *_ in data:
        parts = (text or "").split("\n")
        gone = [key(p) in common and not (first and least[key(p)] == (i is not None, i or 0, j)) for j, p in enumerate(parts)]
        kept = "\n".join(p for p, g in zip(parts, gone, strict=True) if not g)
        out.append((i, len(parts), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("min_docs, min_chars, keep", [(2, 1, "first"), (10, 5, "first"), (3, 7, "none")])
def test_first_occurrences_and_short_keys(llm, min_docs, min_chars, keep):
    data = corpus(seed=2)
    got = lines.line_dedup(llm.createDataFrame(data, SCHEMA).repartition(4), min_docs, min_chars, keep)
    assert sorted(repr(tuple(r)) for r in lines.digest(got).collect()) == plain(data, min_docs, min_chars, keep == "first")


def test_small_filters_lose_nothing(llm, monkeypatch):
    """Filters far too small pass on more suspects; the result is the same."""
    monkeypatch.setattr(lines, "SEGMENT_WORDS", 2)
    monkeypatch.setattr(lines, "MAX_BITS", 128)
    data = corpus(seed=3)
    got = lines.line_dedup(llm.createDataFrame(data, SCHEMA).repartition(6))
    assert sorted(repr(tuple(r)) for r in lines.digest(got).collect()) == plain(data, 10, 1, False)


def test_filters_tell_repeats_from_the_rest(llm):
    data = [(k, f"own {k}\nalso own {k}" + ("\nshared" if k % 100 == 0 else ""), None, None) for k in range(3000)]
    docs = llm.createDataFrame(data, SCHEMA).repartition(7)
    seen = lines.repeat_filter(docs, "text", lines.count_lines(docs, "text"))
    found = lines.suspect_counts(docs, "text", seen).collect()
    assert [r["n"] for r in found if r["n"] > 1] == [30] and len(found) < 20


def test_long_texts_and_long_lines_are_read_in_pieces(llm, monkeypatch):
    monkeypatch.setattr(lines, "PIECE", 64)
    long_line = "y" * 1000
    data = [(k, "\n".join([f"{k} {j}" for j in range(200)] + [long_line, "é" * 50] + [f"{j} {k}" for j in range(200)]), None, None) for k in range(12)]
    got = lines.line_dedup(llm.createDataFrame(data, SCHEMA))
    assert sorted(repr(tuple(r)) for r in lines.digest(got).collect()) == plain(data, 10, 1, False)


def test_empty_table_and_bad_arguments(llm):
    docs = llm.createDataFrame([], SCHEMA)
    assert lines.digest(lines.line_dedup(docs)).collect() == []
    assert lines.line_dedup(docs, keep="first").collect() == []
    with pytest.raises(ValueError):
        lines.line_dedup(docs, min_docs=1)
    with pytest.raises(ValueError):
        lines.line_dedup(docs, keep="last")
