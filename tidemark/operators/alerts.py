"""Alert rules: each rule is one (severity, alert, measure, threshold, fired)
row computed by an aggregate over the monitored tables."""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..functions.signals import ts_lit
from . import monitor

CRITICAL, WARNING, INFO = "critical", "warning", "info"


def _row(df: DataFrame, severity: str, alert: str, measure: Column, threshold: float,
         fired) -> DataFrame:
    """``fired`` maps the measure column to a boolean column."""
    m = df.select(half_up(measure.cast("double"), 6).alias("measure"))
    return m.select(F.lit(severity).alias("severity"), F.lit(alert).alias("alert"), "measure",
                    F.lit(float(threshold)).alias("threshold"),
                    F.coalesce(fired(F.col("measure")), F.lit(False)).alias("fired"))


def feed_stale(tables: dict[str, tuple[DataFrame, str]], now: _dt.datetime, hours: int = 6) -> DataFrame:
    f = monitor.freshness(tables, now).agg(F.max("hours_since_latest").alias("m"))
    return _row(f, CRITICAL, "alert_feed_stale", F.col("m"), hours, lambda m: m > hours)


def sentiment_mean(scores: DataFrame, col: str = "sentiment_score", bound: float = 0.8) -> DataFrame:
    a = scores.agg(F.avg(col).alias("m"))
    return _row(a, CRITICAL, "alert_sentiment_mean", F.col("m"), bound,
                lambda m: (m < -bound) | (m > bound))


def embedding_dim(emb: DataFrame, col: str = "embedding_vector", dim: int = 5) -> DataFrame:
    a = monitor.embedding_dims(emb, col, dim)
    return _row(a, CRITICAL, "alert_embedding_dim", F.col("wrong_dimension_count"), 0, lambda m: m > 0)


def zero_new_filings(filings: DataFrame, now: _dt.datetime, hours: int = 48) -> DataFrame:
    since = ts_lit(now) - F.expr(f"INTERVAL {int(hours)} HOURS")
    a = filings.agg(F.count_if(F.col("filing_date").cast("timestamp_ntz") >= since).alias("m"))
    return _row(a, CRITICAL, "alert_zero_new_filings", F.col("m"), 0, lambda m: m == 0)


def volume_drop(feeds: Sequence[tuple[DataFrame, str]], as_of: _dt.date, ratio: float = 0.5) -> DataFrame:
    """The lowest daily volume of any feed, as a ratio to its 7-day average."""
    lows = [monitor.volume_trend(df, date_col, as_of).agg(F.min("volume_ratio").alias("m")) for df, date_col in feeds]
    a = reduce(lambda x, y: x.unionByName(y), lows).agg(F.min("m").alias("m"))
    return _row(a, WARNING, "alert_volume_drop", F.col("m"), ratio, lambda m: m < ratio)


def risk_surge(filings: DataFrame, as_of: _dt.date, days: int = 7, pct: float = 60.0) -> DataFrame:
    flagged = F.count_if(F.col("risk_category") != "OPERATIONAL")
    a = (filings.filter(F.col("filing_date") >= F.date_sub(F.lit(as_of), days))
         .agg((flagged.cast("double") * 100.0 / F.count(F.lit(1))).alias("m")))
    return _row(a, WARNING, "alert_risk_surge", F.col("m"), pct, lambda m: m > pct)


def accuracy_drop(summary: DataFrame, pct: float = 30.0) -> DataFrame:
    a = summary.agg((F.count_if(F.col("prediction_accuracy") == "Contrary Signal").cast("double")
                     * 100.0 / F.count(F.lit(1))).alias("m"))
    return _row(a, WARNING, "alert_accuracy_drop", F.col("m"), pct, lambda m: m > pct)


def null_sentiment(scores: DataFrame, col: str = "sentiment_score", pct: float = 5.0) -> DataFrame:
    a = scores.agg((F.count_if(F.col(col).isNull()).cast("double") * 100.0 / F.count(F.lit(1))).alias("m"))
    return _row(a, WARNING, "alert_null_sentiment", F.col("m"), pct, lambda m: m > pct)


def schema_changed(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Columns added, removed or of another type or nullability between two
    schema snapshots (``monitor.schema_snapshot``)."""
    a = monitor.schema_drift(current, stored).agg(F.count(F.lit(1)).alias("m"))
    return _row(a, INFO, "alert_schema_changed", F.col("m"), 0, lambda m: m > 0)


def volume_trend_shift(df: DataFrame, date_col: str, days: int = 30, pct: float = 20.0) -> DataFrame:
    daily = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("daily_count"))
    s = monitor.rolling_average_shift(daily, date_col, "daily_count", days)
    a = s.agg(F.max_by("shift_pct", date_col).alias("m"))
    return _row(a, INFO, "alert_volume_trend_shift", F.col("m"), pct, lambda m: m > pct)


def new_ticker(current: DataFrame, history: DataFrame, col: str = "ticker") -> DataFrame:
    new = current.select(col).distinct().join(history.select(col).distinct(), col, "left_anti")
    a = new.agg(F.count(F.lit(1)).alias("m"))
    return _row(a, INFO, "alert_new_ticker", F.col("m"), 0, lambda m: m > 0)


def alerts(rows: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), rows)
