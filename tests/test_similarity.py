"""Many-target cosine search against plain numpy; the index against the exact search."""

import numpy as np
import pytest

from tidemark.operators import similarity as s


def plain(rows, targets, k):
    """{target: [ids]} by cosine, then id."""
    whole = [(i, np.array(v, dtype=float)) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for t, tv in whole:
        if t in targets:
            sims = [(-float(tv @ v) / (np.linalg.norm(tv) * np.linalg.norm(v)), i) for i, v in whole if i != t]
            out[t] = [i for _, i in sorted(sims)[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, vec array<double>").repartition(3)


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["target_id"], r["rank"])):
        out.setdefault(r["target_id"], []).append(r["id"])
    return out


def vectors(n, dim, seed, centres=None):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)) if centres is None else (
        rng.normal(size=(centres, dim))[rng.integers(0, centres, n)] + 0.3 * rng.normal(size=(n, dim)))
    return [(i, x.tolist()) for i, x in enumerate(v)]


def test_blocks_and_groups_find_every_neighbour(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 20)
    monkeypatch.setattr(s, "GROUP", 70)
    rows = vectors(400, 8, 1)
    df = frame(spark, rows)
    assert got(s.cosine_topk_all(df, df.filter("vec_id % 5 = 0"), "vec_id", "vec", k=7)) == plain(rows, set(range(0, 400, 5)), 7)


def test_awkward_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [1.0, None]), (None, [1.0, 0.0]),
            (7, [0.5, 0.5]), (8, [-1.0, 0.0]), (9, [0.5, 0.5])]
    df = frame(spark, rows)
    assert got(s.cosine_topk_all(df, df, "vec_id", "vec", k=3)) == {1: [2, 7, 9], 2: [1, 7, 9], 7: [9, 1, 2], 8: [7, 9, 1], 9: [7, 1, 2]}
    none = df.limit(0)
    assert s.cosine_topk_all(none, df, "vec_id", "vec").count() == 0
    assert s.cosine_topk_all(df, none, "vec_id", "vec").count() == 0


@pytest.mark.parametrize("centres", [None, 30])
def test_index_recall(spark, monkeypatch, centres):
    monkeypatch.setattr(s, "GROUP", 150)                      # cells are cut into parts
    rows = vectors(3000, 16, 3, centres)
    df = frame(spark, rows)
    targets = df.filter("vec_id % 10 = 0")
    index = s.build_index(df, "vec_id", "vec", cell_rows=100)
    assert index.rows.count() == 3000
    found = got(s.index_topk(index, targets, "vec_id", "vec", k=10))
    exact = plain(rows, set(range(0, 3000, 10)), 10)
    recall = sum(len(set(found.get(t, [])) & set(ids)) for t, ids in exact.items()) / (10 * len(exact))
    assert recall >= 0.9
    cells = 1 << index.planes.shape[1]
    probes = s.probes_for(index, s.unit_vectors(targets, "vec_id", "vec"), 10, 0.95)
    if centres:
        assert probes <= cells / 2                            # structure saves cells
    assert got(s.index_topk(index, targets, "vec_id", "vec", k=10, probes=cells)) == exact


def test_likely_cells_start_with_the_own_one():
    rng = np.random.default_rng(4)
    planes, v = rng.normal(size=(6, 5)), rng.normal(size=(20, 6))
    cells = s._likely_cells(v, planes)
    assert (cells[:, 0] == s._signs(v, planes)).all()
    assert all(sorted(row) == list(range(32)) for row in cells.tolist())
