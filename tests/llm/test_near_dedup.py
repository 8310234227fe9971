"""Classes of near copies against all pairs, and the signature's estimate."""

import numpy as np
import pytest
from fixtures import awkward_rows

from tidemark.llm import near_dedup as nd


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts, threshold=0.8):
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shingled = [sets(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            both = len(shingled[i] & shingled[j])
            if (texts[i] or "") == (texts[j] or "") or both and both >= threshold * (len(shingled[i]) + len(shingled[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def classes(spark, docs):
    found = nd.near_duplicates(docs)
    return found.join(nd.representatives(found), "component")


@pytest.mark.parametrize("share", [0.3, 0.8])
def test_signature_estimates_jaccard(share):
    rng = np.random.default_rng(3)
    got = []
    for size in (12, 150, 3000):
        for _ in range(8):
            a = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
            m = int(size * (1 - share) / (1 + share))
            b = np.concatenate([a[m:], rng.integers(0, 2 ** 63, m, dtype=np.uint64)])
            s = nd.dart_minhash([a, b], [np.ones(size)] * 2, 192)
            got.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(got)) < 0.03


def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(4)
    got = []
    for _ in range(20):
        e = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
        x, y = rng.uniform(0.1, 9, 60), rng.uniform(0.1, 9, 60)
        s = nd.dart_minhash([e, e], [x, y], 192)
        got.append((s[0] == s[1]).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum())
    assert abs(np.mean(got)) < 0.03


def test_signature_ignores_company_and_order():
    e = np.arange(40, dtype=np.uint64)
    alone = nd.dart_minhash([e], [np.ones(40)], 64)
    among = nd.dart_minhash([np.arange(7, dtype=np.uint64), e[::-1].copy()], [np.ones(7), np.ones(40)], 64)
    assert (alone[0] == among[1]).all()


def _edited(rng, words, rate):
    return " ".join(f"e{rng.integers(10 ** 9)}" if rng.random() < rate else w for w in words)


def test_classes_equal_all_pairs(spark, tmp_path):
    """A large group of near copies at all distances, copies of copies, and strangers."""
    rng = np.random.default_rng(5)
    base = [f"w{rng.integers(3000)}" for _ in range(160)]
    texts = [_edited(rng, base, r) for r in rng.uniform(0, 0.06, 140)]
    for _ in range(12):                                   # chains of small edits
        t = [f"w{rng.integers(3000)}" for _ in range(120)]
        for _ in range(4):
            t = _edited(rng, t, 0.012).split()
            texts.append(" ".join(t))
    texts += [" ".join(base[:150]), " ".join(base[:130])] + [" ".join(base)] * 30
    texts += [" ".join(f"w{rng.integers(3000)}" for _ in range(60)) for _ in range(40)]
    path = str(tmp_path / "d")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).write.parquet(path)
    got = {r.doc_id: r.class_id for r in classes(spark, spark.read.parquet(path)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_awkward(spark, docs, none):
    rows = classes(spark, docs).collect()
    assert len(rows) == len(awkward_rows())
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[0].class_id == by[1].class_id == by[7].class_id == 0        # a copy, and its capitals
    assert by[2].class_id == by[3].class_id == 2                          # null and empty
    assert by[4].class_id == 4 and by[5].class_id == 5
    assert [r.class_id for r in rows if r.doc_id is None and r.class_size == 3] == [2]    # the null text without an id
    kept = nd.deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.component for r in rows})
    assert classes(spark, none).count() == 0 and nd.deduplicate(none).count() == 0


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 7), (200, 201), (201, 202), (300, 300)]
    got = {r.node: r.component for r in nd.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in [*range(2, 41), 100]) and got[201] == got[202] == 200
