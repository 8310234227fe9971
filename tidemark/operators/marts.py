"""Analytics and ML marts."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up, pct
from ..functions.signals import (composite_score, prediction_accuracy, sentiment_label,
                                 signal_direction, ts_lit)
from ..functions.text import pseudo_embedding
from .indicators import latest_per_key
from .joins import window_aggregates


def mart_earnings_summary(earnings: DataFrame, bars: DataFrame, days: int = 5,
                          events: DataFrame | None = None) -> DataFrame:
    """Post-earnings reaction per (ticker, call date, score, company, quarter, year).

    Windows are evaluated once per distinct (ticker, call_date); groups keep
    calls without bars (left semantics) and classify them as in the
    reference (NULL return -> 'Contrary Signal', 0 returns). ``events`` may
    name the (ticker, call_date) pairs, from a table without texts.
    """
    group = ["ticker", "call_date", "sentiment_score", "company_name", "quarter", "fiscal_year"]
    g = earnings.select(*group).distinct()
    win = window_aggregates(g if events is None else events, bars, 0, days, [
        F.avg("daily_return_pct").alias("avg_5d_return"),
        F.max(F.abs("daily_return_pct")).alias("max_daily_move")])
    j = g.join(win, ["ticker", "call_date"], "left")
    return j.select(
        "ticker", "company_name", "quarter", "fiscal_year", "call_date",
        half_up("sentiment_score", 3).alias("sentiment_score"),
        sentiment_label("sentiment_score").alias("sentiment_label"),
        F.coalesce(half_up(F.col("avg_5d_return") * 100.0, 2), F.lit(0.0))
         .alias("post_earnings_5d_return_pct"),
        F.coalesce(half_up(F.col("max_daily_move") * 100.0, 2), F.lit(0.0))
         .alias("max_daily_move_pct"),
        prediction_accuracy("sentiment_score", "avg_5d_return").alias("prediction_accuracy"))


def risk_counts(filings: DataFrame, as_of: _dt.date, days: int = 30) -> DataFrame:
    return (filings.filter(F.col("filing_date") >= F.date_sub(F.lit(as_of), days))
            .groupBy("ticker")
            .agg(F.count(F.lit(1)).alias("total_risk_flags"),
                 F.count_if(F.col("risk_category") != "OPERATIONAL").alias("high_risk_count")))


def latest_role_call(earnings: DataFrame, role: str = "CEO") -> DataFrame:
    """Latest call per ticker for one speaker role (tie-break: call_id)."""
    calls = (earnings.filter(F.col("speaker_role") == role)
             .select("ticker", "call_date", "call_id", "sentiment_score", "speaker_role"))
    return latest_per_key(calls, "ticker", "call_date", tie="call_id")


def mart_research_signals(metrics: DataFrame, earnings: DataFrame, filings: DataFrame,
                          as_of: _dt.date, now: _dt.datetime, role: str = "CEO",
                          latest_metrics: DataFrame | None = None) -> DataFrame:
    """Latest bar per ticker + latest CEO sentiment + 30-day risk counts.

    All three inputs are reduced to one row per ticker before joining.
    ``latest_metrics`` (one row per ticker, e.g. from
    ``indicators.latest_price_metrics``) replaces the reduction of the full
    ``metrics`` table when given.
    """
    cols = ["ticker", "price_date", "close_price", "ma_20d", "ma_50d", "volatility_20d",
            "sharpe_like_ratio"]
    p = (latest_metrics.select(*cols) if latest_metrics is not None
         else latest_per_key(metrics.select(*cols), "ticker", "price_date"))
    le = latest_role_call(earnings, role).select("ticker", F.col("sentiment_score").alias("ceo_sentiment"))
    rc = risk_counts(filings, as_of)
    j = p.join(le, "ticker", "left").join(rc, "ticker", "left")
    return j.select(
        "ticker", "close_price", "ma_20d", "ma_50d",
        half_up(F.col("volatility_20d") * 100.0, 2).alias("volatility_pct"),
        half_up("sharpe_like_ratio", 2).alias("sharpe_ratio"),
        "ceo_sentiment", "total_risk_flags", "high_risk_count",
        composite_score("sharpe_like_ratio", "ceo_sentiment", "high_risk_count")
         .alias("composite_signal_score"),
        signal_direction("ceo_sentiment", "high_risk_count", "sharpe_like_ratio")
         .alias("signal_direction"),
        ts_lit(now).alias("signal_generated_at"))


def mart_filing_dashboard(filings: DataFrame, high: float = 0.4, medium: float = 0.2) -> DataFrame:
    """Per (ticker, type, fiscal year, quarter). The average section length
    uses the classification model's ``text_length`` (the length of the same
    text), so a materialized intermediate is read without its text column."""
    length = F.col("text_length") if "text_length" in filings.columns else F.length("section_text")
    g = (filings.groupBy("ticker", "filing_type", "fiscal_year", "fiscal_quarter")
         .agg(F.count(F.lit(1)).alias("total_filings"),
              F.count_if(F.col("risk_category") != "OPERATIONAL").alias("risk_flagged_filings"),
              F.count_if(F.col("sentiment_polarity") == "NEGATIVE").alias("negative_sections"),
              F.count_if(F.col("sentiment_polarity") == "POSITIVE").alias("positive_sections"),
              F.avg(length).alias("_avg_len")))
    flagged, total = F.col("risk_flagged_filings"), F.col("total_filings")
    # thresholds as exact decimals: flagged > total * 0.4 has no float edge
    hi, mid = F.lit(Decimal(str(high))), F.lit(Decimal(str(medium)))
    return g.select(
        "ticker", "filing_type", "fiscal_year", "fiscal_quarter", "total_filings",
        "risk_flagged_filings",
        pct(flagged, total, 1).alias("risk_pct"),
        "negative_sections", "positive_sections",
        half_up("_avg_len", 0).alias("avg_section_length"),
        F.when(flagged > total * hi, "HIGH_RISK").when(flagged > total * mid, "MEDIUM_RISK")
         .otherwise("LOW_RISK").alias("risk_level"))


def ml_sentiment_training(earnings: DataFrame, bars: DataFrame, now: _dt.datetime,
                          horizons: tuple[int, int] = (10, 10), cut: float = 0.005,
                          events: DataFrame | None = None) -> DataFrame:
    """Training rows: sentiment feature and forward-return labels.

    ``horizons=(10, 10)`` is faithful (both labels average the 10-day
    window); ``(5, 10)`` gives a true 5-day label in the same pass.
    Only events with at least one bar in (call_date, call_date + max] remain.
    """
    short, long = horizons
    top = max(short, long)
    g = earnings.select("ticker", "call_date", "sentiment_score").distinct()
    win = window_aggregates(g if events is None else events, bars, 1, top, [
        F.avg(F.when(F.col("_days") <= short, F.col("daily_return_pct"))).alias("r_short"),
        F.avg(F.when(F.col("_days") <= long, F.col("daily_return_pct"))).alias("r_long")])
    j = g.join(win, ["ticker", "call_date"], "inner")
    return j.select(
        F.col("call_date").alias("event_date"), "ticker",
        half_up("sentiment_score", 4).alias("sentiment_feature"),
        half_up(F.coalesce("r_short", F.lit(0.0)), 6).alias("label_5d_return"),
        half_up(F.coalesce("r_long", F.lit(0.0)), 6).alias("label_10d_return"),
        F.when(F.col("r_short") > cut, 1).otherwise(0).alias("label_positive_5d"),
        F.when(F.col("r_short") < -cut, 1).otherwise(0).alias("label_negative_5d"),
        ts_lit(now).alias("_training_snapshot_at"))


def ml_filing_embeddings(filings: DataFrame, now: _dt.datetime) -> DataFrame:
    return (filings.filter(F.col("risk_category") != "OPERATIONAL")
            .select("filing_id", "ticker", "filing_type", "filing_date", "item_type",
                    "risk_category", "sentiment_polarity",
                    pseudo_embedding("filing_id").alias("embedding_vector"),
                    ts_lit(now).alias("_embedded_at")))
