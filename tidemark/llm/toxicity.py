"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, documents drawn without a look
at their labels the unlabelled. A document is the set of its words and of
their beginnings and endings of 4 to 6 characters, hashed, each at the
levels "occurs once or more", "twice or more", up to LEVELS. A piece at a
level becomes an input of the linear model if its share among the positives is beyond
chance several times its share among the unlabelled (for a sign of toxicity
alone that ratio tends to 1 / prior, for all else to 1). The model minimises

    prior * R(positive as 1) + max(0, R(unlabelled as 0) - prior * R(positive as 0)),

the class-prior-corrected risk estimator; where the second term would fall
below zero its gradient is turned back, so the model does not learn the
unlabelled by heart. The prior is the toxic share among labelled rows.

All learning is from rows outside the held-out fold: at most about
``POSITIVES`` confirmed and ``UNLABELLED`` other documents, drawn by hash.
Scores read the whole text and nothing else.

Defined results: null and empty texts have no words and get the score of
the bias alone; with no confirmed example every score is 0; several label
rows of a document count as toxic if one says so; of several rows of one id
the least set of features is learned from; repeated rows are scored each for
itself; texts of any length are read whole; a score of exactly 0.5 is
predicted 1; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, table
from .decontaminate import words_of

POSITIVES = 2000
UNLABELLED = 5000
SPACE = 1 << 20                    # hashed pieces
LEVELS = 4                         # feature = piece * LEVELS + level - 1
INPUTS = 2048
SIZES = (4, 5, 6)
LEAST_LIFT, LEAST_Z = 4.0, 6.0
MEMO_WORDS = 400_000


def pieces(word: bytes) -> list[int]:
    """Hashed features of a word: itself, its beginnings, its endings."""
    text = word.decode("utf-8", "replace").lower()
    grams = [f"^{text}$"]
    for n in SIZES:
        if len(text) > n:
            grams += (f"^{text[:n]}", f"{text[-n:]}$")
    return [zlib.crc32(g.encode()) & (SPACE - 1) for g in grams]


def features(words: list[bytes], of_word) -> np.ndarray:
    """The features of a document, ascending."""
    count: Counter[int] = Counter()
    for word, n in Counter(words).items():
        for piece in of_word(word):
            count[piece] += n
    out = [p * LEVELS + level for p, n in count.items() for level in range(min(n, LEVELS))]
    return np.array(sorted(out), dtype=np.int32)


class _Pieces(dict):
    def __missing__(self, word: bytes) -> list[int]:
        if len(self) > MEMO_WORDS:
            self.clear()
        value = self[word] = pieces(word)
        return value


@dataclass
class Model:
    inputs: np.ndarray             # features, ascending
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.gain: dict[int, np.ndarray] = {}          # piece -> weights of its levels
        for f, w in zip(self.inputs.tolist(), self.weights.tolist()):
            self.gain.setdefault(f // LEVELS, np.zeros(LEVELS))[f % LEVELS] = w
        self.memo: dict[bytes, tuple[int, ...]] = {}

    def _known(self, word: bytes) -> tuple[int, ...]:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        own = self.memo[word] = tuple(p for p in pieces(word) if p in self.gain)
        return own

    def score(self, text: bytes | None) -> float:
        count: Counter[int] = Counter()
        get = self.memo.get
        for word, n in Counter(words_of(text)).items():
            own = get(word)
            for piece in self._known(word) if own is None else own:
                count[piece] += n
        z = self.bias + sum(float(self.gain[p][:n].sum()) for p, n in sorted(count.items()))
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def choose_inputs(positive: list[np.ndarray], unlabelled: list[np.ndarray], count: int = INPUTS) -> np.ndarray:
    """Pieces of a far greater share among the positives, most certain first."""
    p = np.bincount(np.concatenate(positive), minlength=SPACE * LEVELS)
    u = np.bincount(np.concatenate(unlabelled), minlength=SPACE * LEVELS)
    a, b = p / len(positive), u / len(unlabelled)
    mean = (p + u) / (len(positive) + len(unlabelled))
    z = (a - b) / np.sqrt(np.maximum(mean * (1 - mean), 1e-12) * (1 / len(positive) + 1 / len(unlabelled)))
    best = np.argsort(-z, kind="stable")[:count]
    return np.sort(best[(z[best] >= LEAST_Z) & (a[best] >= LEAST_LIFT * b[best])])


def train_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05,
               decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear model under the non-negative risk with the logistic loss."""
    w, b = np.zeros(xp.shape[1], np.float64), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for t in range(1, steps + 1):
        zp, zu = xp @ w + b, xu @ w + b
        as_one, as_zero = -(1 - sigmoid(zp)) * prior / len(zp), sigmoid(zp) * prior / len(zp)   # loss gradients in zp
        un_zero = sigmoid(zu) / len(zu)
        corrected = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if corrected >= 0:
            gp, gu = as_one - as_zero, un_zero
        else:                                        # the estimate is below zero: turn it back
            gp, gu = as_zero, -un_zero
        g = np.append(gp @ xp + gu @ xu + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-10)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _draw(of: str, salt: int) -> Column:
    """Uniform in [0, 1), a function of the id."""
    return F.pmod(F.xxhash64(of, F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)


def examples(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES,
             unlabelled: int = UNLABELLED) -> tuple[DataFrame, float]:
    """((positive, features) of the drawn documents, prior)."""
    known = (labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1)), F.lit(0))).first()
    total = docs.count()
    prior = toxic / n if n else 0.0
    # about ``positives`` ids whatever the size of the table, so small enough to broadcast
    drawn = F.broadcast(known.filter((F.col("toxic") == 1) & (_draw("doc_id", 21) * float(max(toxic, 1)) < positives))
                        .select(F.col("doc_id").alias("_id"), F.lit(True).alias("_p")))
    rows = docs.select("doc_id", "text").filter(~held_out()).join(drawn, F.col("doc_id") == F.col("_id"), "left").filter(
        F.col("_p").isNotNull() | (_draw("doc_id", 22) * float(max(total, 1)) < unlabelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Pieces()
        for batch in batches:
            sets = [features(words_of(t), memo.__getitem__) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                              pa.array(sets, pa.list_(pa.int32()))],
                                             names=["doc_id", "positive", "drawn", "features"])

    cols = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("_p", F.lit(False)).alias("positive"),
                       (_draw("doc_id", 22) * float(max(total, 1)) < unlabelled).alias("drawn"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    found = cols.mapInArrow(run, "doc_id long, positive boolean, drawn boolean, features array<int>")
    # one row of a repeated id, so that what is gathered stays as small as the draw
    return found.groupBy("doc_id").agg(F.max("positive").alias("positive"), F.max("drawn").alias("drawn"),
                                       F.min("features").alias("features")), prior


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    rows, prior = examples(docs, labels, positives, unlabelled)
    got = rows.toArrow().sort_by("doc_id")
    sets = [np.asarray(x.values.to_numpy(), dtype=np.int64) for x in got["features"]]
    once = lambda of: list({s.tobytes(): s for s, f in zip(sets, got[of].to_pylist()) if f and len(s)}.values())
    pos, unl = once("positive"), once("drawn")       # copies would pass for evidence
    if not pos or not unl:
        return None
    inputs = choose_inputs(pos, unl)
    place = np.full(SPACE * LEVELS, -1, dtype=np.int64)
    place[inputs] = np.arange(len(inputs))

    def matrix(rows_: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(rows_), len(inputs)), dtype=np.float32)
        for i, s in enumerate(rows_):
            at = place[s]
            x[i, at[at >= 0]] = 1
        return x

    return Model(inputs, *train_nnpu(matrix(pos), matrix(unl), min(max(prior, 1e-3), 0.9)))


def scorer(spark, model: Model | None):
    """Column -> double: the toxicity of a column of texts."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            yield pd.Series([0.0 if m is None else m.score(t) for t in texts])

    return lambda text: score(text.cast("string").cast("binary"))


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    apply = scorer(docs.sparkSession, model)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                        apply(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: the toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
