"""Fitted text models: an extractive summary and a sentiment classifier.

The summary weighs words by how often a text has them and how few texts do.
A sentence counts as much as its distinct words do on average; the best few
are given out in the order of the text. Weights are whole thousandths, so a
result does not depend on the order of additions. Texts are cut into
sentences and words by JVM expressions, word counts are grouped sums, and
nothing but (text, sentence, word) keys is shuffled; texts never are.

The sentiment classifier is a logistic regression on hashed TF-IDF features
(``pyspark.ml``), fitted on a bounded sample of labelled texts and applied to
all. Its score is 2 p - 1, from -1 to 1.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..session import scratch_path

#: A sentence ends at one of these, or with its line.
SENTENCE_END = r"[.!?]+\s+|\n+"
#: Labelled texts that the classifier is fitted on at most, about.
SAMPLE = 20_000


def sentences(texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, place, sentence): the sentences of every text that has any, from 0."""
    parts = F.filter(F.split(F.col(text_col), SENTENCE_END), lambda s: F.regexp_like(s, F.lit(r"\w")))
    return texts.select(key, F.posexplode(parts).alias("place", "sentence"))


def _words(rows: DataFrame, key: str) -> DataFrame:
    """(key, place, word, n): distinct words of each sentence and their number there."""
    word = F.explode(F.regexp_extract_all(F.lower("sentence"), F.lit(r"\w+"), F.lit(0)))
    return rows.select(key, "place", word.alias("word")).groupBy(key, "place", "word").agg(F.count(F.lit(1)).alias("n"))


def sentence_weights(texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, place, weight). A word weighs its number in the text times
    round(1000 ln((texts + 1) / texts with it)); a sentence the mean of its
    distinct words. Frequent words meet their counts in a plain join on the
    word, which AQE cuts where one word has too many rows."""
    words = _words(sentences(texts, key, text_col), key)
    in_text = words.groupBy(key, "word").agg(F.sum("n").alias("tf"))
    known = in_text.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    total = texts.filter(F.col(text_col).isNotNull()).agg(F.count(F.lit(1)).alias("texts"))
    rarity = known.join(total, F.lit(True)).select(          # one row
        "word", F.round(1000 * F.log((F.col("texts") + 1) / F.col("df"))).cast("long").alias("rarity"))
    weighed = in_text.join(rarity, "word").select(key, "word", (F.col("tf") * F.col("rarity")).alias("w"))
    return (words.select(key, "place", "word").join(weighed, [key, "word"]).groupBy(key, "place")
            .agg((F.sum("w") / F.count(F.lit(1))).alias("weight")))


def extractive_summary(texts: DataFrame, key: str, text_col: str, best: int = 2, out: str = "summary") -> DataFrame:
    """(key, summary): the ``best`` sentences of every text, in its order (ties:
    the earlier one); null for a null text, empty for one without words. The
    key must be unique."""
    by = Window.partitionBy(key).orderBy(F.desc("weight"), "place")
    chosen = (sentence_weights(texts, key, text_col).withColumn("_r", F.row_number().over(by)).filter(F.col("_r") <= best)
              .groupBy(key).agg(F.sort_array(F.collect_list("place")).alias("_places")))
    parts = F.filter(F.split(F.col(text_col), SENTENCE_END), lambda s: F.regexp_like(s, F.lit(r"\w")))
    joined = texts.select(key, text_col).join(chosen, key, "left").withColumn("_s", parts)
    return joined.select(key, F.when(F.col(text_col).isNotNull(), F.coalesce(
        F.array_join(F.transform("_places", lambda p: F.get("_s", p)), " "), F.lit(""))).alias(out))


def fit_sentiment(labelled: DataFrame, key: str, text_col: str, label_col: str, features: int = 1 << 14,
                  sample: int = SAMPLE) -> PipelineModel:
    """A classifier of texts from those with label 0 or 1; of more than
    ``sample`` labelled texts about that many are drawn by a hash of the key."""
    known = labelled.filter(F.col(label_col).isNotNull()).select(
        key, F.coalesce(F.col(text_col), F.lit("")).alias(text_col), F.col(label_col).cast("double").alias("label"))
    total = known.count()
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(23)), F.lit(1 << 40)) / float(1 << 40)
    model = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"\w+", gaps=False),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_x"),
        LogisticRegression(featuresCol="_x", labelCol="label", probabilityCol="_p", regParam=0.01, maxIter=50),
    ]).fit(known.filter(draw * max(total, 1) < sample))
    # kept in the shared folder, and used from there without what training left in it
    path = scratch_path(labelled.sparkSession, "sentiment-model")
    model.save(path)
    return PipelineModel.load(path)


def model_sentiment(texts: DataFrame, model: PipelineModel, key: str, text_col: str, out: str = "model_score") -> DataFrame:
    """(key, score) of every text, whole; null for a null text."""
    scored = model.transform(texts.select(key, F.col(text_col).alias("_t"), F.coalesce(F.col(text_col), F.lit("")).alias(text_col)))
    return scored.select(key, F.when(F.col("_t").isNotNull(), half_up(2 * vector_to_array("_p")[1] - 1, 6)).alias(out))
