"""Trained operators on held-out rows, and their defined results."""

import os

import numpy as np
import pytest
from fixtures import awkward_rows

from tidemark.llm import language_id, quality_classifier, toxicity
from tidemark.llm.common import fold_of, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def real(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def test_language_accuracy(real):
    docs, _ = real
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_id.identify(docs, language_id.fit(docs)).collect()
    assert len(rows) == len(lang) and all(r.held_out == (fold_of(r.doc_id) == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_ignores_the_held_out_fold(real):
    from pyspark.sql import functions as F

    docs, _ = real
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "zz").otherwise(F.col("lang")))
    assert "zz" not in language_id.fit(other, per_lang=50).langs


def test_every_language_is_learned(spark):
    """More languages than a thousand, rare ones and ones without a text."""
    rows = [(i, f"l{i % 1100:04d}", f"text {i}") for i in range(11_000)]
    rows += [(20_000 + i, "big", f"big text {i}") for i in range(3000)] + [(30_000 + i, "mute", None) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    want = {lang for i, lang, text in rows if text and fold_of(i)}
    got = language_id.training_windows(df, per_lang=4).toPandas()["lang"].value_counts()
    assert set(got.index) == want and len(want) > 1000 and got["big"] < 20
    few = language_id.training_windows(df, most=50).toPandas()["lang"].value_counts()      # bounded, one of each at least
    assert set(few.index) == want and few.sum() < 1.2 * len(want)


def test_windows_cover_every_byte_once():
    for n in (1, 3, 252, 253, 254, 256, 257, 506, 507, 509, 5000):
        text = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
        x, owner, covered = language_id.windows_of([b"ab", text])
        x, covered = x[owner == 1], covered[owner == 1]
        patches = max(0, n - 3)
        seen = [tuple(row[i:i + 4]) for row in x for i in range(language_id.STRIDE)][:patches]
        assert seen == [tuple(text[i:i + 4]) for i in range(patches)] and covered.sum() == max(1, n)


def test_gradients_are_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 256, (6, language_id.WINDOW), dtype=np.uint8), np.array([0, 1, 2, 0, 1, 2])
    m = language_id.train(x, y, ["a", "b", "c"], epochs=1)
    loss = lambda: -np.log(m.probabilities(x)[np.arange(6), y]).mean()
    params = [m.embed, *m.filters, *m.bias, m.out, m.out_bias]
    for p, g in zip(params, language_id._gradients(m, x, y)):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        was, h = p[i], 1e-2
        p[i] = was + h
        up = loss()
        p[i] = was - h
        down = loss()
        p[i] = was
        assert abs((up - down) / (2 * h) - g[i]) < 0.1 * abs(g[i]) + 2e-3


def test_language_awkward(real, docs, none):
    model = language_id.fit(real[0], per_lang=200)
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == len(awkward_rows())
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {2, 3, 4, 10, 12} <= und and not und & {0, 5, 6}
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.fit(none) is None and language_id.identify(none, model).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the larger tables")
def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect() if r.doc_id in toxic and r.held_out]
    hit = [r.predicted for r in rows if toxic[r.doc_id] == 1]
    false = [r.predicted for r in rows if toxic[r.doc_id] == 0]
    assert np.mean(hit) >= 0.85 and np.mean(false) <= 0.02
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_learns_only_from_its_folds(real):
    from pyspark.sql import functions as F

    docs, labels = real
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, other)
    assert (a.inputs == b.inputs).all() and np.allclose(a.weights, b.weights) and a.bias == b.bias


def test_risk_estimator_separates_without_negatives():
    rng = np.random.default_rng(0)
    u = rng.random((3000, 6)) < 0.2
    toxic = rng.random(3000) < 0.3
    u[:, 0] = toxic & (rng.random(3000) < 0.9)
    p = rng.random((500, 6)) < 0.2
    p[:, 0] = rng.random(500) < 0.9
    w, b = toxicity.train_nnpu(p.astype(np.float32), u.astype(np.float32), 0.3)
    assert w[0] + b > 0 > b and np.abs(w[1:]).max() < w[0] / 3


def test_toxicity_awkward(spark, real, docs, none):
    model = toxicity.fit(*real)
    rows = toxicity.score_documents(docs, model).collect()
    assert len(rows) == len(awkward_rows())
    bias = 1 / (1 + np.exp(-model.bias))
    assert all(abs(r.score - bias) < 1e-9 for r in rows if r.doc_id in (2, 3, 4))
    unlabelled = real[1].limit(0)
    assert toxicity.fit(docs, unlabelled) is None and toxicity.fit(none, real[1]) is None
    assert {r.score for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    assert toxicity.score_documents(none, model).count() == 0


def test_quality_on_held_out_rows(spark, real):
    quality = {r.doc_id: r.quality for r in real[1].collect()}
    rows = {r.doc_id: r for r in quality_classifier.query(spark, SF).collect()}
    assert len(rows) == real[0].count()
    held = [d for d in quality if rows[d].held_out]
    assert np.mean([rows[d].kept for d in held if quality[d] == 1]) >= 0.98
    assert np.mean([rows[d].kept for d in held if quality[d] == 0]) <= 0.2


def test_sparse_sites_shrink(spark):
    rows = [("big", "p", 3.0)] * 400 + [("big", "q", 3.0)] * 400 + [("bad", "p", -3.0)] * 400 + [("one", "p", -3.0)] + [(None, None, 3.0)] * 5
    sites = {(r.host, r.path): r for r in quality_classifier.site_posteriors(spark.createDataFrame(rows, "host string, path string, log_odds double"), 0.0).collect()}
    assert set(sites) == {("big", "p"), ("big", "q"), ("bad", "p"), ("one", "p"), (None, None)}
    prior = sites["one", "p"].prior
    assert abs(sites["one", "p"].host_rate - prior) < abs(sites["bad", "p"].host_rate - prior) and sites["big", "p"].host_rate > 0.9


def test_quality_awkward(spark, real, docs, none):
    kept = quality_classifier.keep_good(docs, real[1].limit(0))        # nothing to learn from
    assert kept.columns == docs.columns and kept.count() == docs.count()
    labels = spark.createDataFrame([(i, i % 2) for i in range(13)] + [(0, None), (1, 1)], "doc_id long, quality int")
    judged = quality_classifier.keep_good(docs, labels)
    assert judged.columns == docs.columns and judged.count() <= docs.count()
    assert quality_classifier.keep_good(none, labels).count() == 0


def test_pipeline_stages(spark):
    """Every stage works on all its predecessor kept; decisions take effect."""
    import corpus_pipeline as cp
    from test_decontaminate import brute
    from test_native import spans

    from tidemark.llm.common import materialize

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in cp.STAGES:
        out = materialize(stage(spark, docs, sf), name)
        if name == "packing":
            sums = {}
            for r in out.collect():
                sums[r.doc_id] = sums.get(r.doc_id, 0) + r.length
                assert r.length <= 2048
            assert set(sums) == set(before)
            break
        assert out.columns == columns
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before) and len(after) == out.count()
        if name == "decontamination":
            items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
            hit = [b[1] for b in brute([r.text for r in before.values()], items, 10)]
            assert set(after) == {d for d, h in zip(before, hit) if not h}
        if name == "secret_scan":
            assert set(after) == set(before) and not any(spans(r.text) for r in after.values())
            assert all(after[d].text == r.text for d, r in before.items() if not spans(r.text))
        else:
            assert all(after[d] == before[d] for d in after)
        docs, before = out, after
