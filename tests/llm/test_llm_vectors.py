"""Top-k inner products against brute force."""

import math
import random

import duckdb
import numpy as np
import pytest

from riskframe.llm import vector_search as V

SF = "/root/testdata/sf0.001"


def top(rows, k=10, every=100, scale=1024):
    valid = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(valid):
        if q is None or q % every:
            continue
        found = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(v, w)))), i is None, i or 0, b)
                       for b, (i, w) in enumerate(valid) if a != b)[:k]
        out += [(q, r + 1, None if n else i, -s) for r, (s, n, i, _) in enumerate(found)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1.0) for i, v in rows], "vec_id long, embedding array<double>, cell long, far double")


def clustered(n, d, seed, groups=6):
    rng = np.random.RandomState(seed)
    centres = rng.normal(size=(groups, d))
    return [(i, (centres[rng.randint(groups)] + rng.normal(size=d) * rng.choice([0.01, 0.2, 1.0])).tolist()) for i in range(n)]


@pytest.mark.parametrize("k", [1, 10])
def test_clusters_hot_vector_and_small_blocks(spark, monkeypatch, k):
    for name, value in (("BLOCK_CELLS", 16 * 8), ("GROUP", 3), ("GROUPS", 2), ("LEAF", 4), ("SAMPLE", 64), ("CENTRES", 7)):
        monkeypatch.setattr(V, name, value)
    rows = clustered(260, 8, 1) + [(i, [0.5] * 8) for i in range(300, 430)]
    random.Random(2).shuffle(rows)
    assert got(V.top_products(frame(spark, rows), k=k, every=20)) == top(rows, k, 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, None), (200, [1.0, None]), (300, [nan, 1.0]), (400, [inf]), (500, []), (None, [3.0, 1.0]),
            (None, [3.0, 1.0]), (-100, [-1.0, -0.0001, 5.0]), (1, [0.1]), (2, [1e-5, -1e-5]), (600, [1e30, 1.0]), (601, [-1e30, 2.0]), (700, [1e308])]
    rows += [(800, [2.0 ** 40 + 0.5, 3.0]), (801, [2.0 ** 41, 7.0])]
    want = [r for r in rows if r[0] != 700]                # beyond 1e100 when scaled
    assert got(V.top_products(frame(spark, rows))) == top(want)


def test_fewer_rows_than_k_and_empty(spark):
    assert V.top_products(frame(spark, [])).count() == 0
    assert V.top_products(frame(spark, [(0, [1.0])])).count() == 0
    rows = [(0, [1.0]), (1, [1.0]), (2, [0.5])]
    assert got(V.top_products(frame(spark, rows))) == top(rows)
    assert V.top_products(frame(spark, [])).columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("n", [1, 5, 400])
def test_cover_tree_invariants(n):
    x = np.array([v for _, v in clustered(n, 5, n)])
    t = V.CoverTree(x, leaf=4)
    assert sorted(t.order) == list(range(n))
    for i in range(len(t.centre)):
        under = t.order[t.lo[i]:t.hi[i]]
        assert t.centre[i] in under
        assert np.sqrt(((x[under] - x[t.centre[i]]) ** 2).sum(axis=1)).max() <= t.radius[i] + 1e-9
        if t.down[i] is not None:
            centres = t.centre[t.down[i]]
            assert t.centre[i] == centres[0] and sorted(np.concatenate([t.order[t.lo[c]:t.hi[c]] for c in t.down[i]])) == sorted(under)
            far = np.sqrt(((x[centres][:, None] - x[centres][None]) ** 2).sum(axis=2)) + np.eye(len(centres)) * 1e9
            assert (t.radius[t.down[i]] <= t.radius[i] / 2 + 1e-9).all() and far.min() > t.radius[i] / 2


def test_walk_drops_pairs(monkeypatch):
    x = np.array([v for _, v in clustered(2000, 6, 3)]) * 1024 // 1
    q = x[:20]
    scored = []
    real = V.products
    monkeypatch.setattr(V, "products", lambda a, b: scored.append(a.shape[0] * b.shape[0]) or real(a, b))
    best = V.Best(20, 5, np.full(20, -2 ** 63))
    V.walk(V.CoverTree(q, leaf=1), V.CoverTree(x), np.arange(2000), np.zeros(2000, bool), np.arange(2000), best)
    for i in range(20):
        assert list(best.score[i]) == sorted((x @ q[i]).astype(int), reverse=True)[:5]
    assert sum(scored) < 20 * 2000 * 0.5


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    rel = con.sql(V.ORACLES["op11_vector_search"])
    assert sorted(rel.fetchall(), key=str) == got(V.q_vector_search(spark, SF))
