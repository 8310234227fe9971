"""Event-window joins: events joined to the bars dated within a calendar-day
window after each event.

The range predicate ``event_date + lo <= bar_date <= event_date + hi`` is
rewritten into an equi-join: each *distinct* (ticker, event_date) is
replicated to the (hi - lo + 1) bar dates it can match and joined to the
unreplicated bars on (ticker, bar_date). There are a few event dates per
ticker and year, so the replicated side is small whatever the number of bars
or events, and the key is as fine as (ticker, day): a ticker with a third of
all rows is no single partition. The result is exact and the cost linear.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_days(events: DataFrame, lo: int, hi: int, key: str, event_date: str) -> DataFrame:
    """(_ek, _ed, _day): every day of the window of each distinct event date."""
    return (events.select(F.col(key).alias("_ek"), F.col(event_date).alias("_ed")).distinct()
            .withColumn("_day", F.explode(F.sequence(F.date_add("_ed", lo), F.date_add("_ed", hi)))))


def bars_in_windows(events: DataFrame, bars: DataFrame, lo: int, hi: int, key: str, event_date: str,
                    bar_date: str, cols: Sequence[str]) -> DataFrame:
    """(_ek, _ed, <cols>): the bars of each distinct (key, event date) window."""
    b = bars.select(F.col(key).alias("_bk"), F.col(bar_date).alias("_bd"), *cols)
    return (window_days(events, lo, hi, key, event_date)
            .join(b, (F.col("_ek") == F.col("_bk")) & (F.col("_day") == F.col("_bd")))
            .select("_ek", "_ed", *cols))


def event_window_join(events: DataFrame, bars: DataFrame, lo: int = 0, hi: int = 5,
                      how: str = "left", key: str = "ticker", event_date: str = "call_date",
                      bar_date: str = "price_date",
                      bar_cols: Sequence[str] = ("price_date", "daily_return_pct")) -> DataFrame:
    """Row-level join of events with the bars inside their window.

    ``lo``/``hi`` are inclusive day offsets; a half-open window
    (event_date, event_date + 10] is ``lo=1, hi=10``. ``how`` is ``left``
    (events without bars kept once, bar columns NULL) or ``inner``.
    """
    w = bars_in_windows(events, bars, lo, hi, key, event_date, bar_date, list(bar_cols))
    return events.join(w, (F.col(key) == F.col("_ek")) & (F.col(event_date) == F.col("_ed")), how).drop("_ek", "_ed")


def window_aggregates(keys: DataFrame, bars: DataFrame, lo: int, hi: int,
                      aggs: Sequence[Column], key: str = "ticker",
                      event_date: str = "call_date", bar_date: str = "price_date",
                      value_cols: Sequence[str] = ("daily_return_pct",)) -> DataFrame:
    """Aggregate the bars of each distinct (key, event_date) window once.

    The number of windows is bounded by tickers x days, not by events.
    Windows without bars are absent here and come back as NULLs when the
    caller left-joins its event groups. ``aggs`` may reference ``_days``
    (bar_date minus event_date).
    """
    w = bars_in_windows(keys, bars, lo, hi, key, event_date, bar_date, [bar_date, *value_cols])
    w = w.select(F.col("_ek").alias(key), F.col("_ed").alias(event_date), bar_date, *value_cols)
    return w.withColumn("_days", F.datediff(F.col(bar_date), F.col(event_date))).groupBy(key, event_date).agg(*aggs)
