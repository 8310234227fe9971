"""Text embeddings computed in Spark (stand-in for a hosted embedding model).

``embed_text`` is latent semantic analysis: hashed TF-IDF rows (document
frequencies are one distributed aggregate), a truncated singular value
decomposition of the whole matrix by Spark, and the rows projected on its
leading right singular vectors, of length one, so cosine similarity is a dot
product. What the driver holds is the basis, ``features x dim`` numbers,
whatever the number of texts. ``tfidf`` gives the rows before that.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import IndexedRowMatrix, RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def tfidf(df: DataFrame, text_col: str, id_col: str, features: int = 1 << 12, min_doc_freq: int = 1) -> DataFrame:
    """(id, features): normalised TF-IDF vectors over hashed words; a null text has none."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"\w+", gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=features)
    idf = IDF(inputCol="_tf", outputCol="_idf", minDocFreq=min_doc_freq)
    nrm = Normalizer(inputCol="_idf", outputCol="features", p=2.0)
    rows = df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    return Pipeline(stages=[tok, tf, idf, nrm]).fit(rows).transform(rows).select(id_col, "features")


def latent_basis(vectors: DataFrame, dim: int) -> np.ndarray:
    """The leading right singular vectors (features x dim at most) of the rows
    ``features``, each with its largest component positive."""
    rows = MLUtils.convertVectorColumnsFromML(vectors.select("features"), "features")
    v = RowMatrix(rows).computeSVD(dim, computeU=False).V.toArray()
    return v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)


def embed_text(df: DataFrame, text_col: str, id_col: str, dim: int = 64, features: int = 1 << 12,
               min_doc_freq: int = 1) -> DataFrame:
    """(id, embedding): ``dim`` latent coordinates (zero beyond the rank of the
    matrix), of length one; all zero for a text without words."""
    spark = df.sparkSession
    if not df.filter(F.regexp_like(F.col(text_col), F.lit(r"\w"))).limit(1).count():      # nothing to learn from
        return df.select(id_col, F.array_repeat(F.lit(0.0), dim).alias("embedding"))
    path = scratch_path(spark, "tfidf")
    tfidf(df, text_col, id_col, features, min_doc_freq).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    vectors = spark.read.parquet(path)
    v = latent_basis(vectors, min(dim, features - 1))
    basis = DenseMatrix(*v.shape, v.ravel(order="F").tolist())
    indexed = MLUtils.convertVectorColumnsFromML(vectors.select("_row", "features"), "features")
    projected = IndexedRowMatrix(indexed.rdd.map(tuple)).multiply(basis).rows.map(lambda r: (r.index, r.vector.toArray().tolist()))
    rows = spark.createDataFrame(projected, "_row long, _x array<double>")
    length = F.sqrt(F.aggregate("_x", F.lit(0.0), lambda a, x: a + x * x))
    unit = F.transform("_x", lambda x: F.when(F.col("_n") > 0, x / F.col("_n")).otherwise(0.0))
    padded = F.concat(unit, F.array_repeat(F.lit(0.0), dim - v.shape[1]))
    return vectors.select(id_col, "_row").join(rows.withColumn("_n", length), "_row").select(id_col, padded.alias("embedding"))


def embed_with_model(df: DataFrame, text_col: str, id_col: str, make_model) -> DataFrame:
    """Embeddings from an external batch model (e.g. an ONNX session).

    ``mapInPandas`` hands Arrow batches of (id, text) to the model, which is
    created once per task by ``make_model()`` and maps a ``pd.Series`` of
    texts to a sequence of vectors. Spark partitions the rows; nothing is
    gathered on the driver.
    """
    import pandas as pd

    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        model = make_model()
        for pdf in batches:
            vecs = model(pdf[text_col])
            yield pd.DataFrame({id_col: pdf[id_col], "embedding": [list(map(float, v)) for v in vecs]})

    return df.select(id_col, text_col).mapInPandas(run, f"{id_col} {id_type}, embedding array<double>")
