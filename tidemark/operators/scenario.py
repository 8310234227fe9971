"""What-if scenarios over the model graph.

A scenario is the same model graph with one model replaced by a perturbed
DataFrame (``ModelGraph.with_overrides``): nothing is copied, the baseline
is never modified, and every downstream model is re-derived from the
override.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.graph import ModelGraph


def stress(df: DataFrame, col: str = "sentiment_score", a: float = 0.6, b: float = -0.2) -> DataFrame:
    """col := col * a + b."""
    return df.withColumn(col, F.col(col) * F.lit(a) + F.lit(b))


def scenario(graph: ModelGraph, overrides: dict) -> ModelGraph:
    return graph.with_overrides(overrides)


def stress_scenario(graph: ModelGraph, a: float = 0.6, b: float = -0.2,
                    model: str = "int_earnings_sentiment", col: str = "sentiment_score") -> ModelGraph:
    return scenario(graph, {model: lambda df: stress(df, col, a, b)})


def scenario_compare(base: DataFrame, stressed: DataFrame, key: str = "ticker",
                     measure: str = "composite_signal_score") -> DataFrame:
    """Baseline vs scenario per key (both sides one row per key)."""
    a = base.select(key, F.col(measure).alias("baseline"))
    b = stressed.select(key, F.col(measure).alias("stress_test"))
    return (a.join(b, key, "inner")
            .select(key, "baseline", "stress_test",
                    (F.col("baseline") - F.col("stress_test")).alias("delta")))
