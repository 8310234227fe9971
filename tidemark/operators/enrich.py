"""Intermediate models: text enrichment of calls and filings, plus the
pluggable model scorer."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.rules import REFERENCE, Lexicon


def int_earnings_sentiment(stg: DataFrame, lex: Lexicon = REFERENCE) -> DataFrame:
    t = F.col("transcript_text")
    return stg.select(
        "call_id", "ticker", "company_name", "call_date", "quarter", "fiscal_year",
        "speaker_name", "speaker_role", "transcript_text",
        tx.sentiment_score(t, "call_id", lex).alias("sentiment_score"),
        tx.theme_summary(t, lex).alias("ai_summary"))


def int_filing_classifications(stg: DataFrame, lex: Lexicon = REFERENCE) -> DataFrame:
    t = F.col("section_text")
    return stg.select(
        "filing_id", "ticker", "company_name", "filing_type", "filing_date",
        "fiscal_year", "fiscal_quarter", "filing_title", "section_text", "item_type",
        tx.risk_category(t, lex).alias("risk_category"),
        tx.polarity(t, lex).alias("sentiment_polarity"),
        tx.text_length(t).alias("text_length"),
        tx.word_count(t).alias("word_count"))


def rule_scorer(lex: Lexicon = REFERENCE) -> Callable:
    """Default scorer: the JVM-side rule compiler (no Python on this path)."""
    def score(df: DataFrame, text_col: str, key_col: str, out_col: str) -> DataFrame:
        return df.withColumn(out_col, tx.sentiment_score(F.col(text_col), key_col, lex))
    return score


def pandas_scorer(make_model: Callable[[], Callable], return_type: str = "double") -> Callable:
    """Scorer backed by an arbitrary batch model (e.g. an ONNX session).

    ``make_model()`` runs once per task (iterator pandas UDF), and the model
    scores Arrow batches of texts (``pd.Series -> pd.Series``).
    """
    @F.pandas_udf(return_type)
    def _udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            yield model(texts)

    def score(df: DataFrame, text_col: str, key_col: str, out_col: str) -> DataFrame:
        return df.withColumn(out_col, _udf(F.col(text_col)))
    return score


def score_with_model(df: DataFrame, text_col: str, out_col: str, scorer: Callable | None = None,
                     key_col: str = "call_id") -> DataFrame:
    """Model-backed score (SENTIMENT/SUMMARIZE stand-in) with a pluggable scorer."""
    scorer = scorer or rule_scorer()
    return scorer(df, text_col, key_col, out_col)

