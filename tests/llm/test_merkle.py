"""Hash trees against a plain recursive one; logs, places, proofs."""

import hashlib
import zlib

import pytest
from fixtures import awkward_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import merkle as m


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k:k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def plain_path(levels, i):
    path = []
    for nodes in levels[:-1]:
        run = range(i - i % 3, min(i - i % 3 + 3, len(nodes)))
        path.append(([nodes[j] for j in run if j < i], [nodes[j] for j in run if j > i]))
        i //= 3
    return path


def plain(rows):
    """doc rows -> list of (doc_id, leaf, subroot, root, proof, folded, verified)."""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        docs = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf(*r))))
        trees.append((docs, plain_levels([leaf(*r) for r in docs])))
    top = plain_levels([lv[-1][0] for _, lv in trees])
    out = []
    for t, (docs, levels) in enumerate(trees):
        for i, r in enumerate(docs):
            path = plain_path(levels, i) + plain_path(top, t)
            held = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None:
                held = (r[0], r[1].replace("\n", ""), *r[2:])
            d = leaf(*held)
            for left, right in path:
                d = H(*left, d, *right)
            proof = H(*(x for left, right in path for x in (*left, *right)))
            out.append((r[0], leaf(*r), levels[-1][0], top[-1][0], proof, d, d == top[-1][0]))
    return out


@settings(deadline=None)
@given(st.integers(1, 200), st.data())
def test_postorder_places(n, data):
    levels = data.draw(st.integers(m.height(n), m.height(n) + 2))
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    log = m.append_log(leaves, levels)
    assert len(log) == sum(m.width(k, n) for k in range(levels + 1))
    nodes = leaves
    for level in range(levels + 1):
        assert [log[m.postorder(level, j, n)] for j in range(len(nodes))] == nodes
        nodes = [m.join_hash(nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
    for i in {0, n // 2, n - 1}:
        path = [([log[k] for k in a], [log[k] for k in b]) for a, b in m.siblings(i, n, levels)]
        assert m.fold(leaves[i], path) == log[-1]
        assert m.unpacked(m._packed(path)) == path


def query_rows(spark, docs, levels):
    from pyspark.sql import functions as F
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))
                      ).otherwise(F.col("text"))
    manifest = m.build(m.leaves(docs, tampered), levels)
    rows = m.proofs(manifest).collect()
    return manifest, [(r["doc_id"], r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), r["proof_sha256"], r["folded_root"].hex(),
                       r["verified"]) for r in rows]


@pytest.mark.parametrize("levels", [1, m.LEVELS])
def test_awkward_documents(spark, docs, levels):
    _, got = query_rows(spark, docs, levels)
    assert sorted(got, key=repr) == sorted(plain([(r[0], r[1], r[2], r[3], r[4]) for r in awkward_rows()]), key=repr)


def test_many_sources_and_tiers(spark):
    rows = [(i, f"text {i}\n" * (i % 4), "en", None if i % 7 == 0 else "hot" if i % 3 else f"s{i % 40}", i % 9) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    manifest, got = query_rows(spark, df, 2)
    assert len(manifest.documents) > 2 and len(manifest.sources) > 1
    assert sorted(got) == sorted(plain(rows))
    assert {g[-1] for g in got} == {True, False}
    for i in (0, 1, 100, 399):
        path = m.proof_of(manifest, rows[i][3], i)
        leaf_, root = next((g[1], g[3]) for g in got if g[0] == i)
        assert m.fold(bytes.fromhex(leaf_), path).hex() == root
    with pytest.raises(KeyError):
        m.proof_of(manifest, "hot", 10_000)


def test_empty_table(spark, none):
    assert m.proofs(m.build(m.leaves(none))).count() == 0
