"""Whitening against numpy's eigendecomposition of the same covariance."""

import math

import numpy as np
import pytest

from pagesieve.llm import whitening
from pagesieve.llm.queries import op13_embedding_whitening


def by_hand(rows, components=32):
    usable = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    lengths = {}
    for _, v in usable:
        lengths[len(v)] = lengths.get(len(v), 0) + 1
    d = max(lengths.items(), key=lambda item: (item[1], item[0]))[0]
    usable = [(k, v) for k, v in usable if len(v) == d]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in usable], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))) for row in x]
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1]
    return usable, n, deviation, centred, values[order], vectors[:, order]


@pytest.mark.parametrize("seed", [0, 1])
def test_against_eigh(spark, seed):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(6, 6)) * np.array([1, 0.5, 0.3, 0.2, 0.1, 0.05])
    rows = [(i, [float(v) for v in rng.normal(size=6) @ mix]) for i in range(300)]
    rows += [(1000, None), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1002, [float("nan")] * 6), (1003, [float("inf")] + [0.0] * 5)]
    rows += [(1004, [0.5] * 5), (7, rows[7][1]), (None, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.whiten(df, "vec_id", "embedding", components=4).collect()
    usable, n, deviation, centred, values, vectors = by_hand(rows)
    assert len(got) == 4 * len(usable) == 4 * 302
    assert {r["n"] for r in got} == {n}
    trace = values.sum()
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], []).append(r)
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-6)
        assert r["identity_error"] <= 1e-9
    for (key, _), dev, c in zip(usable, deviation, centred):
        mine = {r["component"]: r for r in by_row[key] if r["deviation"] == dev}
        assert len(mine) == 4
        for j in range(4):
            expected = c @ vectors[:, j] / math.sqrt(values[j])
            assert abs(mine[j + 1]["whitened"]) == pytest.approx(abs(expected), rel=1e-6, abs=1e-9)
    # One sign for all rows: the signs agree with numpy's up to one flip per component.
    for j in range(4):
        flips = set()
        for (key, _), c in zip(usable[:50], centred[:50]):
            expected = c @ vectors[:, j]
            value = next(r["whitened"] for r in by_row[key] if r["component"] == j + 1)
            if abs(expected) > 1e-6:
                flips.add(np.sign(expected) == np.sign(value))
        assert len(flips) == 1


def test_one_row_empty_and_rank_deficient(spark):
    schema = "vec_id long, embedding array<double>, component string"
    one = whitening.whiten(spark.createDataFrame([(1, [0.1, 0.2], "clash")], schema), "vec_id", "embedding").collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 1, 0, None, None, None),
        (2, 1, 0, None, None, None),
    ]
    assert whitening.whiten(spark.createDataFrame([], schema), "vec_id", "embedding").collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, "x")], schema), "vec_id", "embedding").collect() == []
    flat = [(i, [float(i % 5), 2.0 * (i % 5), 3.0], "y") for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(flat, schema), "vec_id", "embedding").collect()
    live = {r["component"] for r in got if r["whitened"] is not None}
    assert live == {1}
    assert max(r["identity_error"] for r in got) <= 1e-9


def test_query_on_the_table(spark):
    got = op13_embedding_whitening(spark, "/root/testdata/sf0.001").collect()
    assert got and {r["component"] for r in got} == set(range(1, 33))
    assert max(r["identity_error"] for r in got) <= 1e-4
    explained = sorted({(r["component"], r["explained"]) for r in got})
    assert all(a[1] >= b[1] for a, b in zip(explained, explained[1:]))
