import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from obsmatch.llm import op07_token_files as op
from obsmatch.llm.wavelet_file import WaveletFile, encode
from obsmatch.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@given(st.lists(st.integers(0, 70_000), max_size=300), st.integers(0, 70_001))
@settings(max_examples=100, deadline=None)
def test_wavelet_file_equals_the_array(ids, token):
    ids = ids + ids[:40]
    shard = WaveletFile(encode(np.array(ids, np.uint32), np.array([len(ids)])))
    assert shard.decode().tolist() == ids and shard.access(range(len(ids))).tolist() == ids
    for t in {token, *ids[:3]}:
        assert shard.find(t).tolist() == [k for k, v in enumerate(ids) if v == t]
        assert shard.count(t) == ids.count(t) and shard.count(t, len(ids) // 2) == ids[: len(ids) // 2].count(t)


@given(st.lists(st.text(alphabet="aB'sté9 ,.!\n\x1c\x0bµ×<|日́DVll-", max_size=40), max_size=6))
@settings(max_examples=300, deadline=None)
def test_pieces_equal_the_library(texts):
    ids, counts = op.encoder(PATH).encode(texts)
    expected = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


@given(st.lists(st.lists(st.sampled_from(["'s", "'T", "'re", "'ve", "'m", "'ll", "'d", "'", "'l", "r", "É", "ß", "Þ", "7", "42", ".", "''", " ", "\t", "é'", "x" * 63, "Y" * 65, "<", "|", "\x00"]), max_size=9), max_size=5))
@settings(max_examples=300, deadline=None)
def test_contractions_and_long_pieces_equal_the_library(parts):
    texts = ["".join(p) for p in parts]
    ids, counts = op.encoder(PATH).encode(texts)
    expected = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


def test_files_round_trip(llm):
    texts = [None, "", "Hello <|endoftext|> world's 99", "Ünïcode ÉTÉ 日本", "a " * 20_000, "x" * 5000] + [f"doc {k} don't stop" for k in range(60)]
    data = [(k * 7 % 66, t, 1) for k, t in enumerate(texts)] + [(8, t, 1) for t in ("of one", None, "key", "in order")]
    docs = llm.createDataFrame(data + [(None, "null key", 1), data[2]], "doc_id bigint, text string, first int").repartition(5)
    folder = scratch_path(llm, "files")
    op.write_token_files(docs, folder, PATH, shard_tokens=50)
    files = llm.read.parquet(folder)
    assert files.count() > 5  # many shards, each bounded
    got = op.read_token_files(files).collect()
    rows = sorted(data + [(None, "null key", 1), data[2]], key=lambda r: (-1 if r[0] is None else r[0], r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for key, text, _ in rows:
        ids = np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert op.token_files(docs.limit(0), PATH).collect() == []
