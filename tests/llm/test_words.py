import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from obsmatch.llm.common import slices, text_buffers
from obsmatch.llm.words import sequence_fingerprint, shingles, word_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="abZ0 é-ß.\n日", max_size=30)), max_size=8)


@given(texts)
@settings(max_examples=200, deadline=None)
def test_words_equal_the_pattern(values):
    data, offsets = text_buffers(pa.array(values, pa.string()))
    start, end, value, at = word_spans(data, offsets)
    seen = {}
    for k, text in enumerate(values):
        expected = WORD.findall((text or "").translate(LOWER))
        got = [bytes(data[s:e]).decode().translate(LOWER) for s, e in zip(start[at[k] : at[k + 1]], end[at[k] : at[k + 1]])]
        assert got == expected
        for word, h in zip(expected, value[at[k] : at[k + 1]].tolist()):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@given(texts)
@settings(max_examples=100, deadline=None)
def test_fingerprints_and_shingles_do_not_depend_on_the_batch(values):
    def all_of(some):
        data, offsets = text_buffers(pa.array(some, pa.string()))
        _, _, value, at = word_spans(data, offsets)
        hi, lo = sequence_fingerprint(value, at)
        sh, sh_at = shingles(value, at)
        return [(hi[k], lo[k], sh[sh_at[k] : sh_at[k + 1]].tolist()) for k in range(len(some))]

    assert all_of(values) == [all_of([v])[0] for v in values]


def test_slices_cover_everything_once():
    data, offsets = text_buffers(pa.array(["a" * n for n in (0, 5, 50, 1, 0, 3)]))
    found = [(lo, hi, bytes(part), at.tolist()) for lo, hi, part, at in slices(data, offsets, 6)]
    assert [f[:2] for f in found] == [(0, 2), (2, 3), (3, 6)]
    assert b"".join(f[2] for f in found) == bytes(data)
    assert text_buffers(pa.array(["x", "yy", "z"]).slice(1))[1].tolist() == [0, 2, 3]
    assert np.array_equal(text_buffers(pa.array([], pa.string()))[1], [0])
