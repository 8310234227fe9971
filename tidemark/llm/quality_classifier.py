"""Quality classifier: document evidence and hierarchical empirical Bayes.

A logistic model in numpy, trained on both classes weighted alike, reads some
shape features of a whole text: its log-odds are the document's evidence, a
likelihood ratio. Sites are a hierarchy: all documents, hosts, paths of a
host. The mean goodness of each site is shrunk towards its parent's
posterior by a prior strength that is itself estimated from how much the
sites differ (method of moments), so a sparse site says little and a large
one much. A document's posterior log-odds are its evidence plus the log-odds
of its path's posterior without the document.

Only grouped sums leave the documents; a host with a third of all rows is
summed up before the shuffle like any other.

Labels are learned from at most about ``SAMPLE`` labelled rows, drawn by
hash, outside the held-out fold.

For ``documents`` the host is the source and the path the language within
it; ``host`` and ``path`` take any other columns (parse_url for web pages).

Defined results: a null text is empty; an empty text has features like any
other; null hosts and paths are sites like others; a document with several
label rows is good if all say so; with no good or no bad label the evidence
is 0 and every document is kept; of several rows of one id one is learned
from; repeated rows are judged each for itself; texts of any length are read
whole; a score of exactly ``CUT`` is kept; an empty table gives no rows.
Other columns are kept by ``keep_good`` and else ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, materialize, table

SAMPLE = 20_000
#: Documents are rejected below this posterior.
CUT = 0.5

_UPPER, _LOWER, _DIGIT, _SYMBOL, _STOP, _EXCLAIM, _OTHER = range(7)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[ord("A"):ord("Z") + 1] = _UPPER
_CLASS[ord("a"):ord("z") + 1] = _LOWER
_CLASS[128:] = _LOWER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[[ord(c) for c in "#*$%&|<>{}[]_=~^@\\"]] = _SYMBOL
_CLASS[[ord(c) for c in ".,;:"]] = _STOP
_CLASS[[ord(c) for c in "!?"]] = _EXCLAIM


def shape(text: bytes | None) -> list[float]:
    """Features of a whole text; shares, so texts of all lengths compare."""
    text = text or b""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    classes = np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=7) / size
    count = Counter(words)
    pairs = set(zip(words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [np.log1p(len(words)), sum(map(len, words)) / n, *classes[:_OTHER].tolist(),
            len(count) / n ** 0.8, max(count.values(), default=0) / n, same / n, len(pairs) / n ** 0.95,
            1 - len(set(lines)) / max(1, len(lines)), np.log1p(size / max(1, len(lines)))]


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    base: float                    # log-odds of a good label in the sample

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return _expand((x - self.mean) / self.scale) @ self.weights + self.bias


def _expand(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -8, 8)
    return np.hstack([z, z * z])


def train_logistic(x: np.ndarray, y: np.ndarray, steps: int = 200, ridge: float = 1e-3) -> Logistic | None:
    """Newton steps on the ridge-penalised likelihood, classes weighted alike."""
    if not len(y) or y.min() == y.max():
        return None
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.hstack([_expand((x - mean) / scale), np.ones((len(x), 1))])
    c = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (c * (p - y)) + ridge * w
        h = (z * (c * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]), float(np.log(y.mean() / (1 - y.mean()))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Logistic | None:
    known = (labels.filter(~held_out() & F.col("quality").isNotNull()).groupBy("doc_id")
             .agg(F.min("quality").alias("_y")))
    total = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 40)) / float(1 << 40)
    # about ``sample`` ids whatever the size of the table, so small enough to broadcast
    drawn = F.broadcast(known.filter(draw * float(max(total, 1)) < sample).select(F.col("doc_id").alias("_id"), "_y"))
    rows = docs.select("doc_id", "text").join(drawn, F.col("doc_id") == F.col("_id")).select(
        "_id", "_y", _shape()(F.col("text").cast("string").cast("binary")).alias("x"))
    rows = rows.groupBy("_id").agg(F.min(F.struct("_y", "x")).alias("r")).select("r.*").toPandas()      # one row of a repeated id
    if not len(rows):
        return None
    order = sorted(range(len(rows)), key=lambda i: (rows["_y"][i], list(rows["x"][i])))   # whatever order rows came in
    return train_logistic(np.array([rows["x"][i] for i in order]), np.array([rows["_y"][i] for i in order], dtype=float))


def _shape():
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shape(t) for t in texts])
    return run


def evidence(spark, model: Logistic | None):
    """Column of texts -> their own log-odds of being good."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            if m is None or not len(texts):
                yield pd.Series(np.zeros(len(texts)))
            else:
                yield pd.Series(np.clip(m.log_odds(np.array([shape(t) for t in texts])), -30, 30))

    return lambda text: run(text.cast("string").cast("binary"))


def _good(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def base_of(model: Logistic | None) -> float:
    return model.base if model else 0.0


def site_posteriors(evidence_: DataFrame, base: float) -> DataFrame:
    """(host, path, prior, host_rate, n, s, host_n, host_s, k_host, k_path)
    of every path: sums, the posterior mean of its host, prior strengths.

    ``evidence_``: host, path, log_odds. Strength k of a level: the rates of
    its sites around their parent's have variance v of which m (1 - m) / n
    is chance; k = m (1 - m) / (v - chance) - 1, at least 1.
    """
    paths = materialize(evidence_.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_good(F.col("log_odds") + base)).alias("s")), "site-sums")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    all_ = hosts.agg((F.sum("host_s") / F.sum("host_n")).alias("prior"))

    def strength(sites: DataFrame, n: str, s: str, parent: Column) -> DataFrame:
        m = F.least(F.greatest(parent, F.lit(1e-3)), F.lit(1 - 1e-3))
        rate = F.col(s) / F.col(n)
        weighed = sites.agg(F.sum(F.col(n) * (rate - m) ** 2).alias("v"), F.sum(m * (1 - m)).alias("chance"),
                            F.sum(F.col(n) * m * (1 - m)).alias("most"))
        spread = F.greatest(F.col("v") - F.col("chance"), F.col("most") * 1e-4)
        return weighed.select(F.greatest(F.col("most") / spread - 1, F.lit(1.0)).alias("k"))

    k_host = strength(hosts.join(all_, F.lit(True)), "host_n", "host_s", F.col("prior")).select(F.col("k").alias("k_host"))
    shrunk = (hosts.join(all_, F.lit(True)).join(k_host, F.lit(True))
              .withColumn("host_rate", (F.col("host_s") + F.col("k_host") * F.col("prior")) / (F.col("host_n") + F.col("k_host"))))
    shrunk = shrunk.withColumnRenamed("host", "_host")
    joined = paths.join(shrunk, paths["host"].eqNullSafe(shrunk["_host"])).drop("_host")
    k_path = strength(joined, "n", "s", F.col("host_rate")).select(F.col("k").alias("k_path"))
    return materialize(joined.join(k_path, F.lit(True)), "sites")


def judged(rows: DataFrame, sites: DataFrame, base: float) -> DataFrame:
    """``rows`` (row, host, path, log_odds) with evidence, host_rate,
    path_rate, score and kept. The site table is left to the optimiser, which
    broadcasts it only if its measured size allows."""
    at = sites.select([F.col(c).alias(f"site_{c}") for c in sites.columns])
    joined = rows.join(at, F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")), "left")
    own, c = _good(F.col("log_odds") + base), lambda name: F.col(f"site_{name}")
    logit = lambda p: F.log(p / (1 - p))
    bound = lambda p: F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    # without the document itself, at both levels
    joined = joined.withColumn("host_rate", bound((c("host_s") - own + c("k_host") * c("prior")) / (c("host_n") - 1 + c("k_host"))))
    joined = joined.withColumn("path_rate", bound((c("s") - own + c("k_path") * F.col("host_rate")) / (c("n") - 1 + c("k_path"))))
    score = _good(F.col("log_odds") + logit(F.col("path_rate")))
    return joined.select("row", F.col("log_odds").alias("evidence"), "host_rate", "path_rate", score.alias("score"),
                         (score >= CUT).alias("kept"))


def _rows(docs: DataFrame, model: Logistic | None, host: str, path: str, *columns: Column) -> DataFrame:
    return docs.select(*columns, F.col(host).alias("host"), F.col(path).alias("path"),
                       evidence(docs.sparkSession, model)(F.col("text")).alias("log_odds"))


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The documents (all their columns) that are not rejected. Texts are
    judged once: rows and their evidence are written together, and the sums of
    the sites read only the evidence of them."""
    model = fit(docs, labels)
    rows = materialize(_rows(docs, model, host, path, F.struct("*").alias("row")), "judged")
    return judged(rows, site_posteriors(rows, base_of(model)), base_of(model)).filter("kept").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: evidence, site rates and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out")).alias("row")
    thin = materialize(_rows(docs, model, "source", "lang", row), "evidence")
    return judged(thin, site_posteriors(thin, base_of(model)), base_of(model)).select(
        "row.doc_id", "row.held_out", "evidence", "host_rate", "path_rate", "score", "kept")
