"""Threshold classifications used by the marts (all strict comparisons as in
the reference; thresholds are parameters with the reference literals as
defaults)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col_, half_up


def technical_signal(ratio, ret, strong: float = 0.02) -> Column:
    r, x = col_(ratio), col_(ret)
    return (F.when((r > 1.0 + strong) & (x > 0), "STRONG_BUY")
            .when((r > 1.0) & (x > 0), "BUY")
            .when((r < 1.0 - strong) & (x < 0), "STRONG_SELL")
            .when((r < 1.0) & (x < 0), "SELL")
            .otherwise("HOLD"))


def sentiment_label(score, cuts=(0.5, 0.1, -0.1, -0.5)) -> Column:
    s = col_(score)
    return (F.when(s > cuts[0], "Very Positive")
            .when(s > cuts[1], "Positive")
            .when(s > cuts[2], "Neutral")
            .when(s > cuts[3], "Negative")
            .otherwise("Very Negative"))


def prediction_accuracy(score, ret, score_cut: float = 0.3, ret_cut: float = 0.01) -> Column:
    """NULL returns fall through to 'Contrary Signal' (faithful)."""
    s, r = col_(score), col_(ret)
    return (F.when((s > score_cut) & (r > ret_cut), "Accurate Positive")
            .when((s < -score_cut) & (r < -ret_cut), "Accurate Negative")
            .when(F.signum(s) == F.signum(r), "Directionally Correct")
            .otherwise("Contrary Signal"))


def composite_score(sharpe, sentiment, high_risk) -> Column:
    sh = F.coalesce(col_(sharpe), F.lit(0.0))
    se = F.coalesce(col_(sentiment), F.lit(0.0))
    hr = F.coalesce(col_(high_risk), F.lit(0)).cast("double")
    raw = sh * 0.3 + se * 25.0 * 0.4 + (F.lit(1.0) - hr * 0.1) * 10.0 * 0.3
    return half_up(raw, 2)


def signal_direction(sentiment, high_risk, sharpe) -> Column:
    se = F.coalesce(col_(sentiment), F.lit(0.0))
    hr = F.coalesce(col_(high_risk), F.lit(0))
    sh = F.coalesce(col_(sharpe), F.lit(0.0))
    return (F.when((se > 0.5) & (hr <= 1) & (sh > 0), "BULLISH")
            .when((se < -0.3) | (hr >= 3), "BEARISH")
            .otherwise("NEUTRAL"))


def ts_lit(value) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ): the same value in any
    session time zone."""
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _wall(c) -> Column:
    return col_(c).cast("timestamp_ntz")


def hour_diff(start, end) -> Column:
    """Hour boundaries crossed between two timestamps (DATEDIFF(hour)),
    counted on wall-clock fields, so no time-zone or DST arithmetic."""
    a, b = _wall(start), _wall(ts_lit(end) if not isinstance(end, (Column, str)) else end)
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    return days * 24 + (F.hour(b) - F.hour(a)).cast("bigint")


def minute_diff(start, end) -> Column:
    a, b = _wall(start), _wall(ts_lit(end) if not isinstance(end, (Column, str)) else end)
    return hour_diff(a, b) * 60 + (F.minute(b) - F.minute(a)).cast("bigint")


def second_diff(start, end) -> Column:
    a, b = _wall(start), _wall(ts_lit(end) if not isinstance(end, (Column, str)) else end)
    return minute_diff(a, b) * 60 + (F.second(b) - F.second(a)).cast("bigint")
