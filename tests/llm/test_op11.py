import numpy as np
import pandas as pd
import pytest

from obsmatch.llm import op11_vector_codes as codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, extra string, EXTRA2 string"


def plain(vectors, parts, entries, rounds):
    """All parts against all entries, in whole numbers."""
    x = np.floor(np.asarray(vectors, np.float64) * 256).astype(np.int64)
    x = x.reshape(len(x), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        distance = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return distance.argmin(axis=2), distance.min(axis=2)

    for _ in range(rounds):
        own, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                if (own[:, p] == e).any():
                    members = x[own[:, p] == e, p]
                    books[p, e] = np.floor_divide(members.sum(axis=0), len(members))
    own, least = nearest()
    return books, ["".join(f"{c:02x}" for c in row) for row in own], least.sum(axis=1)


def rows_of(n, length, seed, grid=None):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(7, length))
    out = middles[rng.integers(0, 7, n)] + rng.normal(scale=0.3, size=(n, length))
    if grid:  # many ties
        out = np.round(out * grid) / grid
    return out.astype(np.float32)


@pytest.mark.parametrize("n, length, parts, entries, rounds, grid", [(300, 64, 16, 64, 2, None), (400, 32, 16, 16, 4, 2), (40, 16, 16, 64, 2, 1), (200, 12, 3, 8, 6, None)])
def test_ball_k_means_is_plain_k_means(llm, n, length, parts, entries, rounds, grid):
    x = rows_of(n, length, n, grid)
    data = [(3 * k - 50, x[k].tolist(), k % 3, "a", "b") for k in range(n)]
    coded = codes.compress(llm.createDataFrame(data, SCHEMA).repartition(5), parts, entries, rounds)
    books, expect, errors = plain(x, parts, entries, rounds)
    assert (coded.codebooks == books).all()
    got = {r["vec_id"]: (bytes(r["codes"]).hex(), r["error"]) for r in coded.rows.collect()}
    assert got == {3 * k - 50: (expect[k], errors[k]) for k in range(n)}


def test_cores_and_rings_skip_work():
    """The candidates that the rings leave are few, and the nearest entry is always among them."""
    x = codes._quantised(__import__("pyarrow").array(rows_of(2000, 32, 3).tolist()), 32, 16)
    entries = x[:64].transpose(1, 0, 2).copy()
    own, _ = codes.Balls.of(entries).assign(x, np.zeros((len(x), 16), np.int64))
    radius = np.zeros((16, 64))
    distance = np.sqrt(((x - entries[np.arange(16), own]) ** 2).sum(axis=2))
    np.maximum.at(radius, (np.broadcast_to(np.arange(16), own.shape), own), distance)
    balls = codes.Balls.of(entries, radius)
    assert balls.neighbours.mean() < 40
    again, least = balls.assign(x, own)
    full = ((x[:, :, None, :] - entries[None]) ** 2).sum(axis=3)
    assert (again == full.argmin(axis=2)).all() and (least == full.min(axis=2)).all()


def test_query_equals_sql(llm, duck):
    x = rows_of(150, 64, 9, 4)
    data = [(k * 7, x[k].tolist(), None if k % 4 == 0 else k % 3, None, None) for k in range(150)]
    bad = [(1, None, 1), (2, [None] + [0.5] * 63, 1), (3, [float("nan")] + [0.5] * 63, 1), (4, [float("inf")] * 64, None), (5, [float("-inf")] + [0.0] * 63, 2)]
    data += [(*b, None, None) for b in bad]
    got = codes.code_vectors(llm.createDataFrame(data, SCHEMA).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    frame = pd.DataFrame({"vec_id": [d[0] for d in data], "embedding": [d[1] for d in data], "label": pd.array([d[2] for d in data], "Int64")})
    sql = codes.oracle("(SELECT vec_id, embedding::FLOAT[] AS embedding, label FROM t)")
    assert sorted(repr(tuple(r)) for r in got.collect()) == duck(sql, t=frame)


def test_defined_cases(llm):
    assert codes.code_vectors(llm.createDataFrame([], SCHEMA)).collect() == []
    # Other lengths count as filled up with zeros; repeated rows; null ids; huge components; no components.
    data = [(1, [1.0] * 5), (1, [1.0] * 5), (None, [1.0] * 3), (2, []), (3, [3e38] * 5), (4, [-3e38] * 5), (4, [0.0])]
    rows = llm.createDataFrame([(*d, 1, None, None) for d in data], SCHEMA)
    got = codes.code_vectors(rows).collect()
    assert len(got) == len(data) and len({r["codebooks_sha256"] for r in got}) == 1
    assert len({(r["code"], r["error"]) for r in got if r["vec_id"] == 1}) == 1
    empty = codes.code_vectors(llm.createDataFrame([(1, [], 1, None, None), (None, [], None, None, None)], SCHEMA)).collect()
    assert {r["code"] for r in empty} == {"00" * 16} and {r["error"] for r in empty} == {0}
    with pytest.raises(ValueError):
        codes.compress(rows, entries=300)
