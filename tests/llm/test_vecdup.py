"""Near-duplicate embeddings against all pairs."""

import numpy as np
import pytest
from brute import components
from pyspark.sql import functions as F

from crmweave.llm import queries, vecdup
from crmweave.llm.forest import fitted, routed

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, least=0.95):
    """(n_links, component, kept) by row, over all pairs; rows are (key, vector)."""
    size = max((len(v) for _, v in rows if v), default=0)
    good = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    x = np.array([rows[i][1] + [0.0] * (size - len(rows[i][1])) for i in good], float).reshape(len(good), size)
    x /= np.linalg.norm(x, axis=1)[:, None] if len(x) else 1
    a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
    of = components(range(len(good)), zip(a.tolist(), b.tolist(), strict=True))
    name = {}
    for k, i in enumerate(good):
        name[of[k]] = min(name.get(of[k], rows[i][0]), rows[i][0])
    links = np.bincount(np.concatenate([a, b]), minlength=len(good))
    out = [(k, 0, k, True) for k, _ in rows]
    for k, i in enumerate(good):
        out[i] = (rows[i][0], int(links[k]), name[of[k]], rows[i][0] == name[of[k]])
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def near(centre, spread, n, draw):
    return [(centre + spread * draw.standard_normal(len(centre))).astype(np.float32).tolist() for _ in range(n)]


@pytest.fixture(scope="module")
def many():
    """Single vectors, small groups, a dense hub with a wider ring, two hubs that overlap, chains, equal vectors."""
    draw = np.random.default_rng(11)
    point = lambda: draw.standard_normal(24) / 24**0.5
    vectors = [point().tolist() for _ in range(700)]
    for _ in range(60):
        vectors += near(point(), 0.02, 3, draw)
    hub = point()
    vectors += near(hub, 0.02, 300, draw) + near(hub, 0.05, 80, draw) + near(hub, 0.07, 60, draw)
    beside = hub + 0.28 * (other := point()) / np.linalg.norm(other) * np.linalg.norm(hub)
    vectors += near(beside, 0.02, 150, draw)
    vectors += [vectors[0]] * 120 + [(3 * np.array(vectors[1])).tolist()] * 2
    step = np.linspace(0, 2.5, 20)
    vectors += [np.concatenate([[np.cos(t), np.sin(t)], np.zeros(22)]).tolist() for t in step]
    order = draw.permutation(len(vectors))
    return [(int(k), vectors[i]) for k, i in enumerate(order)]


def test_all_links_without_splits(llm, many):
    df = llm.createDataFrame([(*r, None) for r in many], SCHEMA)
    rows = [(r[0], r[1]) for r in df.collect()]
    assert got(vecdup.linked(df)) == plain(rows)


@pytest.mark.parametrize("depth", [10, 2])
def test_recall_with_many_small_leaves(llm, many, monkeypatch, depth):
    """Small leaves and blocks; with a shallow tree, leaves are split again by rounds."""
    import crmweave.llm.forest as forest

    monkeypatch.setattr(vecdup, "BLOCK", 64)
    monkeypatch.setattr(vecdup, "DEPTH", depth)
    monkeypatch.setattr(forest, "DEPTH", depth)
    df = llm.createDataFrame([(*r, None) for r in many], SCHEMA)
    rows = [(r[0], r[1]) for r in df.collect()]
    want, have = plain(rows), got(vecdup.linked(df, leaf=40))
    assert all(h[1] <= w[1] for h, w in zip(have, want, strict=True))
    assert sum(h[1] for h in have) >= 0.99 * sum(w[1] for w in want)


def test_odd_vectors(llm):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 0.0]), (8, [2.0]),
        (9, [-1.0, 0.0]), (9, [1.0, 0.01]), (9, [1.0, 0.01]), (None, [1.0, 0.0]), (None, None), (10, [3e38, 0.0]), (11, [1e-38, 0.0, 0.0]), (-4, [0.0, 1.0]),
        (12, [0.0, 5.0]), (13, [-0.0, 5.0]),
    ]
    df = llm.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    clashing = df.withColumns({c: F.lit("!") for c in ("key", "cid", "rows", "hub", "leaves", "least", "component", "Vector", "n_links", "kept")})
    assert got(vecdup.linked(clashing)) == plain(rows)
    assert vecdup.linked(df.limit(0)).collect() == [] and got(vecdup.linked(df.filter("vec_id = 1"))) == [(1, 0, 1, True)]


def test_query_over_the_small_table(llm):
    df = llm.read.parquet(f"{SMALL}/embeddings.parquet")
    extra = df.limit(40).selectExpr("vec_id + 10000 as vec_id", "transform(embedding, x -> float(x * 1.01)) as embedding", "label")
    rows = [(r[0], r[1]) for r in df.collect()]
    assert got(queries.QUERIES["op12_embedding_duplicates"](llm, SMALL)) == plain(rows)
    both = df.unionByName(extra)
    assert got(vecdup.linked(both)) == plain([(r[0], r[1]) for r in both.collect()])


def test_overlap_keeps_near_pairs_together():
    draw = np.random.default_rng(2)
    x = draw.standard_normal((4000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = x + 0.03 * draw.standard_normal(x.shape)
    y /= np.linalg.norm(y, axis=1)[:, None]
    assert ((x * y).sum(axis=1) > 0.95).all()
    met = np.zeros(len(x), bool)
    for tree in range(4):
        bounds = fitted(x[:2000], tree, 0, 0.02)
        (r, leaf), (s, other) = routed(x, bounds, tree, 0), routed(y, bounds, tree, 0)
        assert set(r) == set(range(len(x))) and np.bincount(leaf).max() < 0.06 * len(x)
        mine = set(zip(r.tolist(), leaf.tolist(), strict=True))
        met[[i for i in zip(s.tolist(), other.tolist(), strict=True) if i in mine and not met[i[0]] for i in i[:1]]] = True
    assert met.mean() > 0.999
