import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from obsmatch.llm.fm_index import FMIndex


@given(st.lists(st.integers(0, 3), min_size=1, max_size=200), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=6), min_size=1, max_size=5), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_search_and_locate_equal_brute_force(text, patterns, rate):
    index = FMIndex(np.array(text), 4, rate)
    width = max(map(len, patterns))
    table = np.zeros((len(patterns), width), np.int64)
    for row, p in zip(table, patterns):
        row[width - len(p) :] = p
    low, high = index.search(table, np.array([len(p) for p in patterns]))
    for p, a, b in zip(patterns, low, high):
        expected = [i for i in range(len(text) - len(p) + 1) if text[i : i + len(p)] == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_long_repeats():
    block = list(np.random.default_rng(0).integers(1, 50, 300))
    text = (block + [0]) * 20
    index = FMIndex(np.array(text), 50)
    low, high = index.search(np.array([block[10:20]]), np.array([10]))
    assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == [10 + 301 * k for k in range(20)]
