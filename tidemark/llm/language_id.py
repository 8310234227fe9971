"""Language identification with a small byte convolutional network.

Bytes are embedded, filters of several widths slide over fixed-length
windows, each filter keeps its maximum over the window, and a softmax reads
the language. Trained in numpy with Adam; the maximum passes its gradient to
one place per filter, so training is cheap. A text is cut into windows that
together hold every filter position of the whole text once; the softmax
outputs of its windows are averaged by the bytes they cover.

Training takes about ``PER_LANG`` windows of each language, drawn by hash from
the labelled rows outside the held-out fold; where that would be more than
``MOST_WINDOWS`` in all, less of each, but never less than one. Every language
with a text to learn from is learned. Inputs are bytes of texts
and, while learning, ``lang``; nothing else.

Defined results: a null text or one without a letter is ``und`` with score
0; with nothing to learn from, every text is ``und``; repeated rows are
predicted each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, table

WINDOW = 256
WIDTHS = (2, 3, 4)
EMBED = 6
FILTERS = 16                       # of each width
PER_LANG = 2500
MOST_WINDOWS = 100 * PER_LANG      # 64 MB
MOST_SCORES = 10_000_000           # numbers (texts or windows, by languages) held at once
CHUNK = 64                         # windows that are convolved at once

# letters and some numerals, told apart by isalpha()
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


@dataclass
class ByteCNN:
    langs: list[str]
    embed: np.ndarray              # 256 x EMBED
    filters: list[np.ndarray]      # per width: (width * EMBED) x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray                # (filters) x langs
    out_bias: np.ndarray

    def joint(self) -> tuple[np.ndarray, np.ndarray]:
        """All filters as one matrix over the widest patch."""
        widest = max(WIDTHS) * EMBED
        full = [np.vstack([w, np.zeros((widest - len(w), w.shape[1]), np.float32)]) for w in self.filters]
        return np.hstack(full).astype(np.float32), np.concatenate(self.bias).astype(np.float32)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Softmax output of each window (n x WINDOW bytes)."""
        weights, bias = self.joint()
        pooled = np.empty((len(windows), weights.shape[1]), np.float32)
        for at in range(0, len(windows), CHUNK):
            patches = _patches(self.embed[windows[at:at + CHUNK]])
            pooled[at:at + CHUNK] = (patches @ weights).max(axis=1)
        return _softmax(np.maximum(pooled + bias, 0) @ self.out + self.out_bias)


def _patches(x: np.ndarray) -> np.ndarray:
    """n x positions x (widest * EMBED): every place of the widest filter."""
    widest = max(WIDTHS)
    v = np.lib.stride_tricks.sliding_window_view(x.reshape(len(x), -1), widest * EMBED, axis=1)[:, ::EMBED]
    return np.ascontiguousarray(v)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


STRIDE = WINDOW - max(WIDTHS) + 1


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows padded with byte 0, number of the text, bytes covered)."""
    count = np.array([max(1, -(-(len(t) - max(WIDTHS) + 1) // STRIDE)) for t in texts], dtype=np.int64)
    out = np.zeros((int(count.sum()), WINDOW), dtype=np.uint8)
    covered = np.empty(len(out), dtype=np.float64)
    at = 0
    for text, n in zip(texts, count.tolist()):
        raw = np.zeros((n - 1) * STRIDE + WINDOW, dtype=np.uint8)
        raw[:len(text)] = np.frombuffer(text, dtype=np.uint8)
        out[at:at + n] = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[::STRIDE]
        covered[at:at + n] = STRIDE
        covered[at + n - 1] = max(1, len(text) - (n - 1) * STRIDE)
        at += n
    return out, np.repeat(np.arange(len(texts)), count), covered


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = 4, rate: float = 0.01,
          seed: int = 7) -> ByteCNN:
    rng = np.random.default_rng(seed)
    m = ByteCNN(langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                [rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)).astype(np.float32) for w in WIDTHS],
                [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))
    params = [m.embed, *m.filters, *m.bias, m.out, m.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), CHUNK):
            x, y = windows[order[at:at + CHUNK]], labels[order[at:at + CHUNK]]
            step += 1
            for p, g, a, b in zip(params, _gradients(m, x, y), first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return m


def _gradients(m: ByteCNN, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    n, rows = len(x), np.arange(len(x))[:, None]
    weights, bias = m.joint()
    patches = _patches(m.embed[x])
    act = patches @ weights
    best = act.argmax(axis=1)                                    # n x filters
    pooled = np.take_along_axis(act, best[:, None, :], 1)[:, 0] + bias
    hidden = np.maximum(pooled, 0)
    d_out = _softmax(hidden @ m.out + m.out_bias)
    d_out[np.arange(n), y] -= 1
    d_out /= n
    d_pool = (d_out @ m.out.T) * (pooled > 0)
    chosen = patches[rows, best]                                 # n x filters x (widest * EMBED)
    d_weights = np.einsum("nf,nfd->df", d_pool, chosen)
    d_patch = d_pool[:, :, None] * weights.T[None]
    d_embed = np.zeros_like(m.embed)
    for k in range(max(WIDTHS)):
        np.add.at(d_embed, x[rows, best + k].ravel(),
                  d_patch[:, :, k * EMBED:(k + 1) * EMBED].reshape(-1, EMBED))
    cut = [slice(i * FILTERS, (i + 1) * FILTERS) for i in range(len(WIDTHS))]
    return [d_embed, *[d_weights[:w * EMBED, c] for w, c in zip(WIDTHS, cut)], *[d_pool.sum(axis=0)[c] for c in cut],
            hidden.T @ d_out, d_out.sum(axis=0)]


def training_windows(docs: DataFrame, per_lang: int = PER_LANG, most: int = MOST_WINDOWS) -> DataFrame:
    """(lang, window): a window of about per_lang documents of each language.

    A row is drawn if its hash is below per_lang / rows of its language, or the
    least of its language: no sort, and no task that gathers a language.
    """
    raw = F.col("text").cast("string").cast("binary")
    size = F.octet_length(raw)
    start = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.greatest(size - WINDOW + 1, F.lit(1)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    known = docs.filter(F.col("lang").isNotNull() & ~held_out() & (size > 0)).select(
        F.col("lang").cast("string").alias("lang"), draw.alias("draw"),
        F.substr(raw, (start + 1).cast("int"), F.lit(WINDOW)).alias("window"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("least")).collect()
    if not counts:
        return known.select("lang", "window").limit(0)
    each = min(per_lang, most / len(counts))
    limits = docs.sparkSession.createDataFrame([(r["lang"], max(each / r["n"], r["least"])) for r in counts],
                                               "_lang string, _limit double")
    # a row per language, as the model has; one window of a repeated id
    return (known.join(F.broadcast(limits), (F.col("lang") == F.col("_lang")) & (F.col("draw") <= F.col("_limit")))
            .groupBy("lang", "draw").agg(F.min("window").alias("window")).select("lang", "window"))


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> ByteCNN | None:
    rows = training_windows(docs, per_lang).toPandas().sort_values(["lang", "window"], ignore_index=True)
    if not len(rows):
        return None
    langs = sorted(set(rows["lang"]))
    x = np.zeros((len(rows), WINDOW), dtype=np.uint8)
    for i, w in enumerate(rows["window"]):
        x[i, :len(w)] = np.frombuffer(bytes(w), dtype=np.uint8)
    return train(x, np.searchsorted(langs, rows["lang"].to_numpy().astype(str)), langs)


def predictor(spark, model: ByteCNN | None):
    """Column -> struct<lang_pred, score> of a column of texts."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            out = pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0})
            lettered = [i for i, t in enumerate(texts)
                        if t is not None and m is not None and has_letter(bytes(t).decode("utf-8", "replace"))]
            lang, score = out["lang_pred"].to_numpy(dtype=object).copy(), np.zeros(len(texts))
            part: list[int] = []
            held = 0
            for j, i in enumerate(lettered):
                part.append(i)
                held += len(texts.iloc[i])
                if held >= 1 << 20 or len(part) * len(m.langs) >= MOST_SCORES or j == len(lettered) - 1:
                    x, owner, covered = windows_of([bytes(texts.iloc[i]) for i in part])
                    total = np.zeros((len(part), len(m.langs)))
                    step = CHUNK * max(1, MOST_SCORES // (CHUNK * len(m.langs)))
                    for at in range(0, len(x), step):
                        now = slice(at, at + step)
                        np.add.at(total, owner[now], m.probabilities(x[now]) * covered[now, None])
                    total /= np.bincount(owner, covered)[:, None]
                    best = total.argmax(axis=1)
                    lang[part] = [m.langs[b] for b in best]
                    score[part] = np.clip(total[np.arange(len(part)), best], 0, 1)
                    part, held = [], 0
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    def apply(text: Column) -> Column:
        return predict(text.cast("string").cast("binary"))

    return apply


def identify(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    apply = predictor(docs.sparkSession, model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       apply(F.col("text")).alias("_p")).select("doc_id", "held_out", "_p.lang_pred", "_p.score")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: the language of every document."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
