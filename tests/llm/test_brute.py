"""Trained operators and thresholds against plain loops over the same numbers."""

import math
from collections import defaultdict

import numpy as np
import pytest
from fixtures import awkward_rows
from pyspark.sql import functions as F

from tidemark.llm import language_id, quality_classifier, quality_rules, toxicity
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


# --------------------------------------------------------------- op2
def plain_probabilities(m, text):
    """Window by window, filter by filter, place by place."""
    stride = language_id.WINDOW - max(language_id.WIDTHS) + 1
    total, weight = np.zeros(len(m.langs)), 0
    for at in range(0, max(1, len(text) - max(language_id.WIDTHS) + 1), stride):
        window = text[at:at + language_id.WINDOW].ljust(language_id.WINDOW, b"\0")
        hidden = []
        for width, filters, bias in zip(language_id.WIDTHS, m.filters, m.bias):
            for f in range(filters.shape[1]):
                best = max(sum(float(m.embed[window[p + k]] @ filters[k * language_id.EMBED:(k + 1) * language_id.EMBED, f]) for k in range(width))
                           for p in range(language_id.WINDOW - max(language_id.WIDTHS) + 1))
                hidden.append(max(0.0, best + float(bias[f])))
        z = np.array(hidden) @ m.out + m.out_bias
        p = np.exp(z - z.max())
        last = at + stride >= max(1, len(text) - max(language_id.WIDTHS) + 1)
        covered = max(1, len(text) - at) if last else stride
        total, weight = total + covered * p / p.sum(), weight + covered
    return total / weight


def test_language_against_plain_convolution(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 256, (20, language_id.WINDOW), dtype=np.uint8)
    m = language_id.train(x, rng.integers(0, 3, 20), ["a", "b", "c"], epochs=1)
    texts = ["x", "ab", "words " * 45, "Ein etwas längerer Satz, " * 25]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_id.identify(df, m).collect():
        p = plain_probabilities(m, texts[r["doc_id"]].encode())
        assert r["lang_pred"] == m.langs[int(p.argmax())] and r["score"] == pytest.approx(p.max(), abs=1e-4)


@pytest.mark.parametrize("text, lettered", [("½ ² ①", False), ("1٣²", False), ("²a", True), ("é", True), ("_-_", False), ("漢", True)])
def test_numerals_are_no_letters(text, lettered):
    assert language_id.has_letter(text) == lettered == any(c.isalpha() for c in text)


def test_a_repeated_id_gives_one_window(spark):
    rows = [(7, f"text number {i}", "en") for i in range(500)] + [(i, "ein Satz", "de") for i in (1, 2, 3, 4, 6)]
    got = language_id.training_windows(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert got.filter("lang = 'en'").count() <= 1


# --------------------------------------------------------------- op3
def plain_posteriors(rows, base):
    good = lambda z: 1 / (1 + math.exp(-z))
    n, s = defaultdict(int), defaultdict(float)
    for host, path, z in rows:
        n[host, path] += 1
        s[host, path] += good(z + base)
    hn, hs = defaultdict(int), defaultdict(float)
    for h, p in n:
        hn[h] += n[h, p]
        hs[h] += s[h, p]
    prior = sum(hs.values()) / sum(hn.values())

    def strength(sites):
        v = chance = most = 0.0
        for count, total, parent in sites:
            m = min(max(parent, 1e-3), 1 - 1e-3)
            v += count * (total / count - m) ** 2
            chance += m * (1 - m)
            most += count * m * (1 - m)
        return max(most / max(v - chance, most * 1e-4) - 1, 1.0)

    kh = strength([(hn[h], hs[h], prior) for h in hn])
    rate = {h: (hs[h] + kh * prior) / (hn[h] + kh) for h in hn}
    kp = strength([(n[x], s[x], rate[x[0]]) for x in n])
    bound = lambda p: min(max(p, 1e-6), 1 - 1e-6)
    out = []
    for host, path, z in rows:
        own = good(z + base)
        hr = bound((hs[host] - own + kh * prior) / (hn[host] - 1 + kh))
        pr = bound((s[host, path] - own + kp * hr) / (n[host, path] - 1 + kp))
        out.append((z, hr, pr, good(z + math.log(pr / (1 - pr)))))
    return out


def test_quality_posteriors_against_plain_loops(spark):
    rng = np.random.default_rng(6)
    rows = [(None if i % 11 == 0 else f"h{i % 5}", None if i % 7 == 0 else f"p{i % 3}", float(rng.normal(0.5 * (i % 5) - 1, 1.5))) for i in range(400)]
    rows += [("lone", "x", -4.0), ("tie", "x", 0.0), ("tie", "x", 0.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, host string, path string, log_odds double").repartition(4)
    for base in (0.0, 0.7):
        got = {r["row"]: r for r in quality_classifier.judged(df, quality_classifier.site_posteriors(df, base), base).collect()}
        for i, (z, hr, pr, score) in enumerate(plain_posteriors(rows, base)):
            assert (got[i]["evidence"], got[i]["host_rate"], got[i]["path_rate"], got[i]["score"]) == pytest.approx((z, hr, pr, score))
            assert got[i]["kept"] == (got[i]["score"] >= 0.5)


# --------------------------------------------------------------- op4
def plain_nnpu(xp, xu, prior, steps, rate=0.05, decay=1e-4):
    d = len(xp[0])
    w = [0.0] * (d + 1)
    m, v = [0.0] * (d + 1), [0.0] * (d + 1)
    z = lambda x: sum(a * b for a, b in zip(w, [*x, 1.0]))
    sig = lambda t: 1 / (1 + math.exp(-t))
    for t in range(1, steps + 1):
        negative = sum(math.log1p(math.exp(z(x))) for x in xu) / len(xu) - prior * sum(math.log1p(math.exp(z(x))) for x in xp) / len(xp)
        g = [0.0] * (d + 1)
        for x in xp:            # d/dz of log(1 + e^-z) is -(1 - sigmoid), of log(1 + e^z) sigmoid
            slope = (prior * (-(1 - sig(z(x))) - sig(z(x))) if negative >= 0 else prior * sig(z(x))) / len(xp)
            for k, a in enumerate([*x, 1.0]):
                g[k] += slope * a
        for x in xu:
            slope = (1 if negative >= 0 else -1) * sig(z(x)) / len(xu)
            for k, a in enumerate([*x, 1.0]):
                g[k] += slope * a
        for k in range(d):
            g[k] += decay * w[k]
        for k in range(d + 1):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * v[k] + 0.001 * g[k] ** 2
            w[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (math.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-10)
    return w


@pytest.mark.parametrize("prior", [0.3, 0.9])                  # the second drives the corrected risk below zero
def test_toxicity_training_against_plain_loops(prior):
    rng = np.random.default_rng(7)
    xp, xu = (rng.random((15, 3)) < 0.6).astype(float), (rng.random((40, 3)) < 0.3).astype(float)
    w, b = toxicity.train_nnpu(xp, xu, prior, steps=40)
    assert [*w, b] == pytest.approx(plain_nnpu(xp.tolist(), xu.tolist(), prior, 40), rel=1e-6, abs=1e-9)


def test_toxicity_score_against_features(spark):
    model = toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    memo = toxicity._Pieces()
    texts = [r["text"] for r in table(spark, SF, "documents").limit(40).collect()] + [r[1] for r in awkward_rows()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weight = dict(zip(model.inputs.tolist(), model.weights.tolist()))
    for r in toxicity.score_documents(df, model).collect():
        raw = texts[r["doc_id"]]
        own = toxicity.features(toxicity.words_of(raw.encode() if raw is not None else None), memo.__getitem__)
        z = model.bias + sum(weight.get(int(f), 0.0) for f in own)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


# --------------------------------------------------------------- op10
def test_kept_against_exact_quantiles(spark):
    """Sketches of fewer values than they hold are exact."""
    least = 20
    counts = quality_rules.document_counts(table(spark, SF, "documents"))
    metrics = quality_rules.metrics()
    rows = counts.select("doc_id", "lang", "source", quality_rules.base_rule_failed().alias("failed"), *[m.value.alias(m.name) for m in metrics]).collect()
    passed = [r for r in rows if not r["failed"]]

    def group(r):
        for same in (lambda x: x["lang"] == r["lang"] and x["source"] == r["source"], lambda x: x["lang"] == r["lang"], lambda x: True):
            found = [x for x in passed if same(x)]
            if len(found) >= least:
                return found
        return passed

    want = {}
    for r in rows:
        kept, of = not r["failed"], group(r)
        for m in metrics:
            values = [x[m.name] for x in of if x[m.name] is not None]
            if r[m.name] is None or not values:
                continue
            lo, mid, hi = np.quantile(values, [1 - m.level, 0.5, m.level], method="inverted_cdf")
            kept &= not r[m.name] > hi + max(hi - mid, m.tie) * m.reach
            if m.low:
                kept &= not r[m.name] < lo - max(mid - lo, m.tie) * m.reach
        want[r["doc_id"]] = kept
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(table(spark, SF, "documents"), least).collect()}
    assert got == want and 0 < sum(want.values()) < len(want)


# --------------------------------------------------------------- pipeline
@pytest.fixture
def folder(spark, tmp_path):
    def make(docs, labels, items):
        for name, df in (("documents", docs), ("labels", labels), ("benchmark", items)):
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return make


def test_pipeline_takes_awkward_rows(spark, docs, folder):
    import corpus_pipeline
    labels = spark.createDataFrame([(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([("a", None), ("b", ""), (None, "seven wise owls read old books near the quiet harbour")], "item_id string, text string")
    out = corpus_pipeline.run(spark, folder(docs, labels, items))
    got = out.collect()
    # of the empty texts one stays; those with the benchmark's window go, whatever their copies
    assert {r["doc_id"] for r in got} == {2, 4, 5, 6, 9, 10, 11, 12}
    assert all(r["length"] <= 2048 for r in got)


def test_pipeline_takes_empty_tables(spark, none, folder):
    import corpus_pipeline
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id string, text string")
    assert corpus_pipeline.run(spark, folder(none, labels, items)).count() == 0
