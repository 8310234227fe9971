"""Ranking and similarity search."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up


def topk(df: DataFrame, order: Sequence[Column], k: int = 10) -> DataFrame:
    """ORDER BY ... LIMIT k (planned as TakeOrderedAndProject: each task keeps
    its own top k, the driver merges k x tasks rows)."""
    return df.orderBy(*order).limit(k)


def topk_bullish(signals: DataFrame, k: int = 10) -> DataFrame:
    cols = ["ticker", "close_price", "ceo_sentiment", "composite_signal_score", "signal_direction"]
    return topk(signals.filter(F.col("signal_direction") == "BULLISH").select(*cols),
                [F.col("composite_signal_score").desc_nulls_last(), F.col("ticker").asc()], k)


def rank_post_earnings(summary: DataFrame,
                       classes: Sequence[str] = ("Accurate Positive", "Accurate Negative")) -> DataFrame:
    return (summary.filter(F.col("prediction_accuracy").isin(*classes))
            .select("ticker", "sentiment_label", "post_earnings_5d_return_pct", "prediction_accuracy")
            .orderBy(F.abs("post_earnings_5d_return_pct").desc(), F.col("ticker")))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    den = norm(a) * norm(b)
    return dot(a, b) / F.when(den != 0, den)


def cosine_topk(vectors: DataFrame, id_col: str, vec_col: str, target_id, k: int = 10,
                digits: int = 6, extra_cols: Sequence[str] = ()) -> DataFrame:
    """Top-k cosine neighbours of one target vector (target excluded).

    The target vector is a scalar subquery: evaluated once, it is a
    one-value constant in every task, so scoring is a single narrow scan
    and the top-k a per-task heap plus a k x tasks merge.
    """
    v = vectors.select(id_col, F.col(vec_col).cast("array<double>").alias("_v"), *extra_cols)
    target = vectors.filter(F.col(id_col) == F.lit(target_id)).select(
        F.col(vec_col).cast("array<double>")).scalar()
    scored = (v.filter(F.col(id_col) != F.lit(target_id))
              .withColumn("_t", target)          # subqueries may not sit inside lambdas
              .select(id_col, *extra_cols, cosine(F.col("_v"), F.col("_t")).alias("_sim")))
    top = topk(scored, [F.col("_sim").desc_nulls_last(), F.col(id_col).asc()], k)
    return top.select(id_col, *extra_cols, half_up("_sim", digits).alias("cosine_similarity"))
