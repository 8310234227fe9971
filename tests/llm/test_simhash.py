"""Fingerprints against plain loops, components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from fixtures import awkward_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import simhash as s


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, distance=4):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


@settings(deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAb ÉI \n\t\x0b\x1c\x85")), max_size=80))
def test_fingerprint(text):
    assert s.fingerprint(text.encode()) == plain_fingerprint(text)


def test_long_text_crosses_blocks():
    text = " ".join(f"w{i % 977}x{i % 31}" for i in range(70_000))
    assert s.fingerprint(text.encode()) == plain_fingerprint(text)


@settings(deadline=None, max_examples=300)
@given(st.integers(0, 2 ** 64 - 1), st.sets(st.integers(0, 63), max_size=4), st.sampled_from([0, 0xFF, 0xF0F0F0F0 << 20]))
def test_every_near_pair_meets_on_a_viable_chain(x, bits, fixed):
    bits = {b for b in bits if not fixed >> b & 1}
    y = x ^ sum(1 << b for b in bits)
    meet = [budgets for mask, budgets in s.ring_keys(fixed) if x & mask == y & mask]
    assert any(all(((x ^ y) & part).bit_count() <= most for part, most in budgets) for budgets in meet)


def test_keys_fix_three_eighths():
    assert len(s.ring_keys(0)) == 40 and all(mask.bit_count() == 24 for mask, _ in s.ring_keys(0))
    fixed, steps = 0, 0
    while 64 - fixed.bit_count() > 8:
        fixed, steps = s.ring_keys(fixed)[0][0], steps + 1
    assert steps <= 6 and 2 ** (64 - fixed.bit_count()) <= s.CHUNK


def found(spark, fps, **kw):
    nodes = spark.createDataFrame([(s._signed(f),) for f in set(fps)], "fp long").repartition(4)
    got = {r["node"] & (1 << 64) - 1: r["component"] for r in s.links(nodes, **kw).collect()}
    groups = {}
    for f in set(fps):
        groups.setdefault(got.get(f, s._signed(f)), set()).add(f)
    return sorted(map(sorted, groups.values()))


def expected(fps):
    groups = {}
    for f, root in plain_components(fps).items():
        groups.setdefault(root, set()).add(f)
    return sorted(map(sorted, groups.values()))


def test_random_and_planted(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(300)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 7))) for f in fps[:150]]
    fps += [0, 1, 2 ** 64 - 1, 2 ** 63, 15, 31]
    assert found(spark, fps) == expected(fps)


def test_hot_bucket_goes_on_over_its_free_bits(spark, monkeypatch):
    """Many fingerprints share 40 bits and lie 5 or more apart: large buckets
    of many components, no links but a few planted ones."""
    rng = np.random.default_rng(8)
    monkeypatch.setattr(s, "CHUNK", 32)
    fps = [int(x) for x in rng.integers(0, 2 ** 24, 500)]
    fps += [f ^ 0b1111 for f in fps[:30]]
    assert found(spark, fps) == expected(fps)


def test_dense_group_needs_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(s, "CHUNK", 32)
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(600)]
    assert found(spark, fps) == expected(fps)


def test_awkward_documents(spark, docs):
    rows = awkward_rows()
    prints = [plain_fingerprint(r[1]) for r in rows]
    root = plain_components(prints)
    least = {}
    for r, f in zip(rows, prints):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    want = sorted(((r[0], s._signed(f), least.get(root[f])) for r, f in zip(rows, prints)), key=repr)
    got = sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in s.near_duplicates(docs).collect()), key=repr)
    assert got == want


def test_query_against_all_pairs(spark):
    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.001"
    t = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    prints = dict(zip(t["doc_id"], map(plain_fingerprint, t["text"])))
    root = plain_components(prints.values())
    least = {}
    for d, f in prints.items():
        least[root[f]] = min(least.get(root[f], d), d)
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in s.query(spark, sf).collect()}
    assert got == {(d, f"{f:016x}", least[root[f]]) for d, f in prints.items()}


def test_empty_table(spark, none):
    assert s.near_duplicates(none).count() == 0


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_other_distances(spark, distance):
    rng = random.Random(distance)
    fps = [rng.getrandbits(64) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), distance)) for f in fps[:20]]
    groups = {}
    for f, r in plain_components(fps, distance).items():
        groups.setdefault(r, set()).add(f)
    assert found(spark, fps, distance=distance) == sorted(map(sorted, groups.values()))
