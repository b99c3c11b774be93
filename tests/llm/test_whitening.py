"""Contour integration and whitening against dense eigenvalues in numpy and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from crmweave.llm import queries, whitening
from crmweave.llm.feast import eigenpairs, inertia, slices

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def symmetric(values, seed=0):
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    made = (turn * np.array(values, float)) @ turn.T
    return (made + made.T) / 2


SPECTRA = {
    "apart": [100, 50, 25, 12, 6, 3, 1, 0.5, 0.1, 0.01], "equal": [2.0] * 20, "close": [1 + 1e-9 * i for i in range(12)] + [5, 5, 0],
    "low rank": [9.0, 4.0] + [0.0] * 14, "one": [3.0], "wide": list(np.geomspace(1e-8, 1e6, 40)), "noise": list(np.linspace(50, 60, 64)),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_slices_hold_the_largest_eigenvalues(name):
    values = sorted(SPECTRA[name], reverse=True)
    m = symmetric(values)
    for shift in (-1.0, 0.037, 1.5, 4.9, 55.123, 1e5):
        assert inertia(m, shift) == (sum(v > shift for v in values), 0)
    got = []
    for low, high, count in slices(m, 6):
        e, x = eigenpairs(m, low, high, count)
        assert len(e) == count and np.abs(m @ x - x * e).max() < 1e-12 * max(values) and np.abs(x.T @ x - np.eye(count)).max() < 1e-12
        got += sorted(e, reverse=True)
    assert len(got) >= min(6, len(values)) and np.abs(np.array(got) - values[: len(got)]).max() < 1e-12 * max(values)


def test_counts_at_an_eigenvalue():
    assert inertia(np.eye(5) * 2, 2.0) == (0, 5) and inertia(np.diag([1.0, 2.0, 3.0]), 2.0) == (1, 1)
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == (1, 0) and inertia(np.zeros((0, 0)), 1.0) == (0, 0)


def check(rows, vectors, components=32):
    """Result rows against the usable vectors, by id."""
    size = max(map(len, vectors.values()))
    x = {i: [math.floor(64 * float(c)) + 1_000_000 for c in v] + [1_000_000] * (size - len(v)) for i, v in vectors.items()}
    n, sums = len(x), [sum(c) for c in zip(*x.values(), strict=True)]
    moved = {i: [n * a - s for a, s in zip(v, sums, strict=True)] for i, v in x.items()}
    y = np.array([[a / n for a in moved[i]] for i in x])
    v = y.T @ y / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    rank = int((e > 16 * size * np.finfo(float).eps * e[0]).sum())
    count = min(components, rank)
    assert len(rows) == n * count
    got = np.zeros((n, count))
    at = {i: k for k, i in enumerate(x)}
    for r in rows:
        assert r["n"] == n and r["deviation"] == sum(a * a for a in moved[r["vec_id"]])
        assert abs(r["explained"] - e[r["component"] - 1] / e.sum()) <= 1e-9 * r["explained"] and r["identity_error"] < 1e-8
        got[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    centred = got - got.mean(axis=0)
    assert np.abs(centred.T @ centred / n - np.eye(count)).max() < 1e-8
    want = y @ (axes[:, :count] / np.sqrt(e[:count]))
    for k in range(count):
        gap = min([abs(e[k] - e[j]) for j in (k - 1, k + 1) if 0 <= j < len(e)], default=e[0])
        if gap > 1e-6 * e[0]:
            sign = np.sign(got[:, k] @ want[:, k])
            assert np.abs(sign * got[:, k] - want[:, k]).max() < 1e-6


def test_query_over_the_small_table(llm):
    vectors = {r["vec_id"]: r["embedding"] for r in llm.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    df = queries.QUERIES["op11_whitening"](llm, SMALL)
    assert [t for _, t in df.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    check(df.collect(), vectors)


def test_odd_vectors(llm):
    draw = np.random.default_rng(4)
    good = {i: draw.standard_normal(5).astype(np.float32).tolist() for i in range(30)}
    good |= {40: [0.5, 0.25], 41: [], 42: good[0], 43: good[0]}
    bad = {50: None, 51: [1.0, None], 52: [float("nan")] * 5, 53: [1.0, float("inf"), 0.0, 0.0, 0.0], 54: [None] * 9}
    rows = [(i, v, None) for i, v in (good | bad).items()]
    df = llm.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("!") for c in ("key", "n", "deviation", "whitened", "at", "Component")})
    check(whitening.whitened(df).collect(), good)
    check(whitening.whitened(df.repartition(5), components=2).collect(), good, 2)


def test_tables_without_variance(llm):
    for rows in ([], [(1, None, 1)], [(1, [], 1), (2, [], 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]):
        assert whitening.whitened(llm.createDataFrame(rows, SCHEMA)).collect() == []


def test_numbers_that_longs_do_not_hold(llm):
    rows = [(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [0.0, 3.0], 0)]
    got = whitening.whitened(llm.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in got if r["deviation"] is None} == {1, 2} and {r["vec_id"] for r in got} == {1, 2, 3}
    assert all(abs(r["whitened"]) < 3 for r in got)
