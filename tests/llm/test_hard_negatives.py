"""Hard negatives against every anchor with every row."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as h


def brute(rows, every, positives=5, negatives=3):
    """rows: (vec_id, label, vector), in the order that breaks ties of vec_id."""
    rows = [(v, lab, [math.floor(256 * x) for x in vec], k) for k, (v, lab, vec) in enumerate(rows)
            if v is not None and lab is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec)]
    out = []
    for v, lab, vec, k in rows:
        if v % every:
            continue
        scored = [(-sum(a * b for a, b in zip(vec, w)), u, j, l2) for u, l2, w, j in rows if j != k]
        best = sorted(s for s in scored if s[3] == lab)[:positives]
        for ps, p, _, _ in best:
            fits = sorted(s for s in scored if s[3] != lab and 50 * -ps <= 100 * -s[0] <= 95 * -ps)[:negatives]
            out += [(v, p, r + 1, n, -ps, -ns) for r, (ns, n, _, _) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, every, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").coalesce(1)
    return sorted(tuple(r) for r in h.mine(h.vectors(df, F.col("label")), F.col("vec_id") % every == 0, **kw).collect())


def clustered(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    v = centres[rng.integers(0, 5, n)] + 0.2 * rng.normal(size=(n, dim))
    return [(i, int(rng.integers(0, labels)), x.tolist()) for i, x in enumerate(v)]


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 40), st.integers(0, 10 ** 6))
def test_tree_is_least_and_parents_come_first(n, seed):
    v = np.random.default_rng(seed).integers(-30, 30, size=(n, 3)).astype(float)
    order, parent, depth = h.spanning_tree(v)
    assert sorted(order) == list(range(n)) and parent[0] == -1 and all(0 <= p < i for i, p in enumerate(parent) if i)
    assert all(depth[i] == depth[p] + 1 for i, p in enumerate(parent) if i)
    x = v[order]
    total = sum(((x[i] - x[p]) ** 2).sum() ** 0.5 for i, p in enumerate(parent) if i)
    edges = sorted((((v[i] - v[j]) ** 2).sum() ** 0.5, i, j) for i in range(n) for j in range(i))
    root, plain = list(range(n)), 0.0

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for length, i, j in edges:
        if find(i) != find(j):
            root[find(i)] = find(j)
            plain += length
    assert total == pytest.approx(plain)


def test_shares_are_exact():
    s = np.array([0, 1, -1, 39, 40, 41, -41, 2 ** 61, -(2 ** 61) + 1])
    assert h.share(s, (50, 100), up=True).tolist() == [-(-50 * int(x) // 100) for x in s]
    assert h.share(s, (95, 100), up=False).tolist() == [95 * int(x) // 100 for x in s]


@pytest.mark.parametrize("block", [3, 4096])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(h, "FEWEST", 40)
    rows = clustered(300, 6, 1)
    want = brute(rows, 10)
    assert want and mined(spark, rows, 10, block=block) == want


def test_bounds_pass_over_most_candidates():
    """Where anchors are near each other, few candidates are scored."""
    rows = clustered(600, 16, 2)
    v = np.array([256 * np.array(r[2]) for r in rows]).round()
    order, parent, depth = h.spanning_tree(v[:100])
    import pyarrow as pa
    up = v[:100][order]
    edge = np.where(parent < 0, 0, np.sqrt(((up - up[parent]) ** 2).sum(axis=1)))
    t = pa.table({"vec": pa.array((up / 256).tolist(), pa.list_(pa.float64())), "parent": parent, "depth": depth, "edge": edge,
                  "uid": order, "vec_id": order, "label": np.zeros(100, dtype=np.int64)})
    block = h.Block(t, 16, 3)
    ids = np.arange(100, 600)
    scored = sum(block.scan(v[k:k + 50], ids[k - 100:k - 50], np.zeros(50, dtype=np.int64), ids[k - 100:k - 50]) for k in range(100, 600, 50))
    assert scored < 0.5 * 100 * 500
    slot, score, vec_id, _ = block.best.rows
    exact = up @ v[100:].T
    for a in range(100):
        best = sorted(zip(-exact[a], ids))[:3]
        assert [(-s, i) for s, i in best] == list(zip(score[slot == a], vec_id[slot == a]))


def test_ties_repeated_and_missing_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 0.1]), (3, 2, [0.9, 0.1]), (3, 2, [0.9, 0.1]),
            (4, 3, [0.6]), (5, 3, [0.7, 0.0, 5.0]), (6, None, [1.0, 0.0]), (7, 2, None), (8, 2, [nan, 0.0]), (9, 2, [0.9, None]), (10, 2, [inf, 0.0]),
            (11, 2, []), (None, 2, [0.9, 0.1]), (12, 5, [-1.0, 0.0]), (14, 6, [0.0, 0.0]), (16, 6, [0.0, 0.0])]
    assert mined(spark, rows, 2) == brute(rows, 2)


def test_large_components(spark):
    rows = [(i, i % 2, [1e5 * (i % 7 + 1), -3e4 * (i % 5), 0.5]) for i in range(40)]
    assert mined(spark, rows, 4) == brute(rows, 4)


def test_empty_tables(spark):
    assert mined(spark, [], 2) == []
    assert mined(spark, [(1, 1, [1.0])], 2) == []
