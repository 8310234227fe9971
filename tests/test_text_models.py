"""Summary, sentiment model and latent embeddings against plain versions."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.ml.functions import vector_to_array

from tidemark.operators import embeddings, text_models

TEXTS = [
    "Revenue grew fast. Margins fell a little! Costs were flat.\nWe expect more growth. Revenue, revenue, revenue.",
    "The quick fox runs. The slow dog sleeps. The the the the.", "one", "", None, "... !!!", "No end here",
    "Same words. Same words. Same words.", "Grüße aus Köln. Über alles wächst Gras! 2024 was fine? Yes.",
]


def plain_summary(texts, best=2):
    cut = [[s for s in re.split(r"[.!?]+\s+|\n+", t) if re.search(r"\w", s, re.A)] if t is not None else None for t in texts]
    words = [[re.findall(r"\w+", s.lower(), re.A) for s in ss] if ss is not None else [] for ss in cut]
    n = sum(t is not None for t in texts)
    df = Counter(w for ws in words for w in {x for s in ws for x in s})
    out = []
    for ss, ws in zip(cut, words):
        if ss is None:
            out.append(None)
            continue
        tf = Counter(x for s in ws for x in s)
        weight = {w: c * int(math.floor(1000 * math.log((n + 1) / df[w]) + 0.5)) for w, c in tf.items()}
        score = [sum(weight[w] for w in set(s)) / len(set(s)) for s in ws]
        chosen = sorted(sorted(range(len(ss)), key=lambda i: (-score[i], i))[:best])
        out.append(" ".join(ss[i] for i in chosen))
    return out


def test_summary_against_plain_version(spark):
    texts = TEXTS + [" ".join(f"w{i % k}" + "." * (i % 5 == 0) for i in range(300)) for k in (7, 30, 100)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    got = {r["id"]: r["summary"] for r in text_models.extractive_summary(df, "id", "text").collect()}
    assert got == dict(enumerate(plain_summary(texts)))
    assert text_models.extractive_summary(df.limit(0), "id", "text").count() == 0


def test_sentiment_model_on_held_out_texts(spark):
    rng = np.random.default_rng(2)
    good, bad, other = ["growth", "strong", "record"], ["loss", "weak", "decline"], [f"w{i}" for i in range(40)]
    rows = []
    for i in range(600):
        y = int(rng.integers(0, 2))
        words = [*rng.choice(good if y else bad, 3), *rng.choice(other, 12)]
        rows.append((i, " ".join(rng.permutation(words)), y))
    df = spark.createDataFrame(rows + [(1000, None, None), (1001, "", None)], "id long, text string, y int")
    model = text_models.fit_sentiment(df.filter("id < 300"), "id", "text", "y")
    got = {r["id"]: r["model_score"] for r in text_models.model_sentiment(df, model, "id", "text").collect()}
    assert got[1000] is None and -1 <= got[1001] <= 1
    held = [(got[i] > 0) == bool(y) for i, _, y in rows if i >= 300]
    assert sum(held) >= 0.95 * len(held)


def test_latent_space_equals_numpy(spark):
    rng = np.random.default_rng(3)
    topics = [[f"t{t}w{i}" for i in range(8)] for t in range(6)]
    texts = [" ".join(rng.choice(topics[i % 6], 12)) + f" x{i % 5}" for i in range(90)]
    df = spark.createDataFrame([*enumerate(texts), (200, ""), (201, None), (202, "?!")], "id long, text string").repartition(3)
    rows = embeddings.tfidf(df, "text", "id", features=256).withColumn("a", vector_to_array("features")).collect()
    a = np.array([r["a"] for r in rows])
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert s[4] - s[5] > 0.01                                           # a gap, so the subspace is one
    got = {r["id"]: np.array(r["embedding"]) for r in embeddings.embed_text(df, "text", "id", dim=5, features=256).collect()}
    want = a @ vt[:5].T
    for r, w in zip(rows, want):
        e = got[r["id"]]
        if r["id"] >= 200:
            assert not e.any()
        else:
            assert abs(np.linalg.norm(e) - 1) < 1e-9
    ids = [i for i, r in enumerate(rows) if r["id"] < 200]
    w = want[ids] / np.linalg.norm(want[ids], axis=1, keepdims=True)
    g = np.array([got[rows[i]["id"]] for i in ids])
    assert np.abs(w @ w.T - g @ g.T).max() < 1e-6                       # the same subspace, whatever its axes


def test_latent_vectors_of_little(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, None)], "id long, text string")
    got = {r["id"]: r["embedding"] for r in embeddings.embed_text(df, "text", "id", dim=8, features=64).collect()}
    assert all(len(v) == 8 for v in got.values()) and not any(got[3])
    assert embeddings.embed_text(df.limit(0), "text", "id").count() == 0
