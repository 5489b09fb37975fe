import numpy as np
import pandas as pd
import pytest

from obsmatch.llm import e8
from obsmatch.llm.op01_embeddings import near_embeddings, oracle

SCHEMA = "vec_id bigint, embedding array<float>, label int, rid string, a int"


def vectors(size, groups, spread, seed):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        centre = rng.normal(size=size)
        for _ in range(int(rng.integers(1, 12))):
            out.append((centre + rng.normal(size=size) * spread * np.linalg.norm(centre) / np.sqrt(size)).astype(np.float32).tolist())
    return out


def check(llm, duck, data, **options):
    frame = pd.DataFrame([r[:3] for r in data], columns=["vec_id", "embedding", "label"])
    frame["label"] = frame["label"].astype("Int32")
    frame["vec_id"] = frame["vec_id"].astype("Int64")
    got = near_embeddings(llm.createDataFrame(data, SCHEMA), **options).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(repr(tuple(r)) for r in got.collect()) == duck(oracle("v0"), v0=frame)


def test_shells_of_the_lattice():
    v, norm = e8.near_vectors()
    assert (norm == 2).sum() == 240 and (norm == 4).sum() == 2160
    assert len(np.unique(v, axis=0)) == 2400


def test_every_cell_near_a_point_is_listed():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)) * 2
    for radius in (0.15, 0.4):
        rows, points = e8.cells_within(x, radius)
        listed = {(r, tuple(np.rint(2 * p))) for r, p in zip(rows.tolist(), points)}
        for _ in range(50):
            step = rng.normal(size=x.shape)
            near = x + radius * step / np.linalg.norm(step, axis=1, keepdims=True)
            for r, p in enumerate(e8.decode(near)):
                assert (r, tuple(np.rint(2 * p))) in listed
    with pytest.raises(ValueError):
        e8.cells_within(x, 0.5)


@pytest.mark.parametrize("size,chunk", [(64, 512), (64, 3), (10, 4)])
def test_equals_brute_force(llm, duck, size, chunk):
    data = [(k, v, k % 2, "x", 1) for k, v in enumerate(vectors(size, 30, 0.17, 5))]
    data += [(1000 + k, data[3][1], data[3][2], "x", 1) for k in range(9)]  # equal vectors
    check(llm, duck, data, chunk=chunk)


def test_long_vectors_go_in_several_batches(llm, duck):
    """1,536 coordinates have over 1,000 entries a vector, each with its 6 KB: far more than one batch holds."""
    data = [(k, v, k % 2, "x", 1) for k, v in enumerate(vectors(1536, 6, 0.14, 9))]
    check(llm, duck, data)


def test_odd_rows(llm, duck):
    one = [1.0, 2.0, 3.0]
    data = [(1, one, 0, "", 0), (2, one, None, "", 0), (3, None, 0, "", 0), (4, [0.0] * 3, 0, "", 0), (5, [1.0, None, 3.0], 0, "", 0), (6, [], 0, "", 0)]
    data += [(7, [float("nan"), 1.0, 1.0], 0, "", 0), (8, [float("inf"), 1.0, 1.0], 0, "", 0), (9, [2.0, 4.0, 6.0], 0, "", 0), (10, [1.0, 2.0], 0, "", 0), (11, one, 1, "", 0)]
    check(llm, duck, data)
    null_id = near_embeddings(llm.createDataFrame([(None, [5.0, -1.0], 0, "", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in null_id] == [(None, 0, None, True)]
    assert near_embeddings(llm.createDataFrame([], SCHEMA)).collect() == []
