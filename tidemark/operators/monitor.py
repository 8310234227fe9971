"""Monitoring queries: freshness, volume, schema, score and signal health,
refresh/CDC/job status, bounds and a quality scorecard.

``as_of`` / ``now`` are parameters. Every query aggregates first; the only
unpartitioned windows run over one row per day or per group.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, pct, safe_div
from ..functions.signals import hour_diff, minute_diff, second_diff, ts_lit
from .indicators import rolling_group_count, share_of_total


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def freshness(tables: dict[str, tuple[DataFrame, str]], now: _dt.datetime) -> DataFrame:
    """Per source: latest date, hour boundaries since it, row count."""
    parts = []
    for name, (df, col) in tables.items():
        parts.append(df.agg(F.max(col).alias("latest_date"), F.count(F.lit(1)).alias("total_records"))
                     .select(F.lit(name).alias("source"), "latest_date",
                             hour_diff(F.col("latest_date"), ts_lit(now)).alias("hours_since_latest"),
                             "total_records"))
    return _union(parts)


def volume_trend(df: DataFrame, date_col: str, as_of: _dt.date, days: int = 30, n: int = 7) -> DataFrame:
    recent = df.filter(F.col(date_col) >= F.date_sub(F.lit(as_of), days))
    return rolling_group_count(recent, date_col, n)


def volume_drop(trend: DataFrame, date_col: str, ratio: float = 0.5) -> DataFrame:
    return (trend.filter(F.col("volume_ratio") < ratio)
            .select(date_col, "daily_count", "rolling_7d_avg",
                    half_up(F.col("volume_ratio") * 100.0, 1).alias("volume_pct_of_avg")))


def schema_snapshot(df: DataFrame, name: str) -> DataFrame:
    """Per column: name, type, nullability and non-null / null counts.

    All counts come from one aggregate over the table; the schema part is
    the table's own metadata, stacked with ``stack`` (no driver data).
    """
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("_n"),
                    *[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(fields)])
    def lit(v: str) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"{lit(f.name)}, {lit(f.dataType.simpleString())}, {str(f.nullable).lower()}, _c{i}"
                     for i, f in enumerate(fields))
    stacked = counts.selectExpr(
        "_n", f"stack({len(fields)}, {rows}) AS (column_name, data_type, is_nullable, non_null_count)")
    return stacked.select(F.lit(name).alias("table_name"), "column_name", "data_type", "is_nullable",
                          "non_null_count", (F.col("_n") - F.col("non_null_count")).alias("null_count"))


def schema_unexpected(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Columns present but not in the expected list (case-insensitive), with
    the number of rows that fill them."""
    known = {e.upper() for e in expected}
    extra = df.select(*[c for c in df.columns if c.upper() not in known])
    if not extra.columns:
        extra = df                                   # nothing unexpected: the join below leaves no row
    snap = schema_snapshot(extra, "t").select("column_name", "data_type", "non_null_count")
    exp = df.sparkSession.createDataFrame([(e.upper(),) for e in expected], "expected string")
    return snap.join(exp, F.upper(F.col("column_name")) == F.col("expected"), "left_anti")


def schema_drift(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Full-outer diff of two snapshots on column_name: added / removed /
    type or nullability changed."""
    a = current.select("column_name", F.col("data_type").alias("new_type"),
                       F.col("is_nullable").alias("new_nullable"))
    b = stored.select("column_name", F.col("data_type").alias("old_type"),
                      F.col("is_nullable").alias("old_nullable"))
    j = a.join(b, "column_name", "full_outer")
    change = (F.when(F.col("old_type").isNull(), "ADDED").when(F.col("new_type").isNull(), "REMOVED")
              .when(F.col("old_type") != F.col("new_type"), "TYPE_CHANGED")
              .when(F.col("old_nullable") != F.col("new_nullable"), "NULLABILITY_CHANGED"))
    return j.withColumn("change", change).filter(F.col("change").isNotNull())


def score_distribution(df: DataFrame, col: str) -> DataFrame:
    x = F.col(col)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        half_up(F.avg(x), 4).alias("mean_sentiment"),
        half_up(F.stddev_samp(x), 4).alias("std_sentiment"),
        F.min(x).alias("min_sentiment"), F.max(x).alias("max_sentiment"),
        F.count_if(x.isNull()).alias("null_count"),
        pct(F.count_if(x.isNull()), F.count(F.lit(1)), 2).alias("null_pct"))


def score_outliers(df: DataFrame, col: str, z: float = 3.0,
                   keep: Sequence[str] = ("call_id", "ticker", "call_date")) -> DataFrame:
    """Rows more than ``z`` sample standard deviations from the mean.

    Mean and deviation come from one scalar subquery (a single aggregate
    pass returning a struct); the filtering scan then sees two constants,
    with no join at all.
    """
    stats = df.agg(F.struct(F.avg(col).alias("m"), F.stddev_samp(col).alias("s")).alias("st"))
    st = stats.scalar()
    scored = df.withColumn("_z", F.abs(F.col(col) - st["m"]) / F.when(st["s"] != 0, st["s"]))
    return (scored.filter(F.col("_z") > z)
            .select(*keep, col, half_up("_z", 2).alias("z_score")))


def category_distribution(df: DataFrame, col: str = "risk_category") -> DataFrame:
    return share_of_total(df, col, "record_count", "pct_of_total", 2)


def risk_surge(df: DataFrame, as_of: _dt.date, days: int = 7, threshold: float = 60.0) -> DataFrame:
    flagged = F.count_if(F.col("risk_category") != "OPERATIONAL")
    g = (df.filter(F.col("filing_date") >= F.date_sub(F.lit(as_of), days))
         .groupBy("filing_date")
         .agg(F.count(F.lit(1)).alias("total_filings"), flagged.alias("risk_flagged")))
    share = F.col("risk_flagged").cast("double") * 100.0 / F.col("total_filings")
    return (g.filter(share > threshold)
            .select("filing_date", "total_filings", "risk_flagged",
                    half_up(share, 1).alias("risk_pct")))


def embedding_dims(df: DataFrame, col: str = "embedding_vector", dim: int = 5) -> DataFrame:
    v = F.col(col)
    return df.agg(F.count(F.lit(1)).alias("total_embeddings"),
                  F.count_if(F.size(v) != dim).alias("wrong_dimension_count"),
                  F.count_if(v.isNull()).alias("null_embedding_count"))


def embedding_drift(df: DataFrame, col: str = "embedding_vector") -> DataFrame:
    return (df.groupBy(F.size(col).cast("bigint").alias("dimension"))
            .agg(F.count(F.lit(1)).alias("count")))


def signal_distribution(signals: DataFrame) -> DataFrame:
    s = F.col("composite_signal_score")
    return (signals.groupBy("signal_direction")
            .agg(F.count(F.lit(1)).alias("ticker_count"), half_up(F.avg(s), 2).alias("avg_composite_score"),
                 F.min(s).alias("min_score"), F.max(s).alias("max_score")))


def stale_signals(signals: DataFrame, now: _dt.datetime, hours: int = 24) -> DataFrame:
    h = hour_diff(F.col("signal_generated_at"), ts_lit(now))
    return (signals.select("ticker", "signal_generated_at", h.alias("hours_stale"))
            .filter(F.col("hours_stale") > hours))


def accuracy_distribution(summary: DataFrame) -> DataFrame:
    return share_of_total(summary, "prediction_accuracy", "occurrence_count", "pct_of_total", 2)


def accuracy_degradation(summary: DataFrame, threshold: float = 30.0) -> DataFrame:
    contrary = F.count_if(F.col("prediction_accuracy") == "Contrary Signal")
    g = (summary.groupBy("fiscal_year", "quarter")
         .agg(F.count(F.lit(1)).alias("total_predictions"), contrary.alias("contrary_count")))
    share = F.col("contrary_count").cast("double") * 100.0 / F.col("total_predictions")
    return (g.filter(share > threshold)
            .select("fiscal_year", "quarter", "total_predictions", "contrary_count",
                    half_up(share, 1).alias("contrary_pct")))


def refresh_health(log: DataFrame, now: _dt.datetime, lags: dict[str, str] | None = None) -> DataFrame:
    """Per refreshed table: state of its latest run, lag target, last
    refresh time and minute boundaries since (one partial aggregate)."""
    latest = (log.groupBy("name")
              .agg(F.max_by(F.struct("completed_time", "state"), "completed_time").alias("_r")))
    lag_rows = [(k, v) for k, v in (lags or {}).items()]
    out = latest.select(F.col("name").alias("table_name"), F.col("_r.state").alias("state"),
                        F.col("_r.completed_time").alias("last_refresh_time"))
    if lag_rows:
        lagdf = log.sparkSession.createDataFrame(lag_rows, "table_name string, target_lag string")
        out = out.join(lagdf, "table_name", "left")
    else:
        out = out.withColumn("target_lag", F.lit(None).cast("string"))
    return out.select("table_name", "state", "target_lag", "last_refresh_time",
                      second_diff(F.col("last_refresh_time"), ts_lit(now)).alias("seconds_since_last_refresh"),
                      minute_diff(F.col("last_refresh_time"), ts_lit(now)).alias("minutes_since_refresh"))


def refresh_stuck(log: DataFrame, now: _dt.datetime, hours: int = 6,
                  active_state: str = "FRONTEND_REFRESHING") -> DataFrame:
    h = refresh_health(log, now)
    hs = hour_diff(F.col("last_refresh_time"), ts_lit(now))
    return (h.filter((F.col("state") != active_state) & (hs > hours))
            .select("table_name", "state", hs.alias("hours_since_refresh")))


def cdc_throughput(registry: DataFrame, counts: DataFrame) -> DataFrame:
    """Stream registry LEFT JOIN per-stream change statistics."""
    return (registry.join(counts, "stream_name", "left")
            .select("stream_name", "source_table", "stream_created", "total_inserts",
                    "total_updates", "total_deletes", "last_activity"))


def cdc_inactive(registry: DataFrame, counts: DataFrame, now: _dt.datetime, hours: int = 24) -> DataFrame:
    t = cdc_throughput(registry, counts)
    h = hour_diff(F.col("last_activity"), ts_lit(now))
    return (t.select("stream_name", "source_table", "last_activity", h.alias("hours_inactive"))
            .filter(F.col("hours_inactive") > hours))


def job_history(log: DataFrame, now: _dt.datetime, hours: int = 24) -> DataFrame:
    since = ts_lit(now) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return (log.filter(F.col("completed_time") >= since)
            .select(F.col("name").alias("task_name"), "completed_time", "state", "error_code"))


def run_health(log: DataFrame, now: _dt.datetime, lags: dict[str, str] | None = None) -> DataFrame:
    """``refresh_health`` over a run log that says more: why the latest run
    took place, how many there were, rows taken in, and the latest error."""
    more = log.groupBy(F.col("name").alias("table_name")).agg(
        F.max_by("refresh_reason", "completed_time").alias("refresh_reason"), F.count(F.lit(1)).alias("runs"),
        F.sum("input_rows").alias("input_rows"),
        F.max_by("error_message", F.when(F.col("error_message").isNotNull(), F.col("completed_time"))).alias("last_error"))
    return refresh_health(log, now, lags).join(more, "table_name")


def job_summary(log: DataFrame, now: _dt.datetime, days: int = 7) -> DataFrame:
    """Per job over the last ``days``: runs, failures, rows, latest error."""
    since = ts_lit(now) - F.expr(f"INTERVAL {int(days)} DAYS")
    failed = F.col("state") == "FAILED"
    return (log.filter(F.col("completed_time") >= since).groupBy(F.col("name").alias("task_name"))
            .agg(F.count(F.lit(1)).alias("runs"), F.count_if(failed).alias("failed_runs"), F.sum("input_rows").alias("input_rows"),
                 F.max_by("error_code", F.when(failed, F.col("completed_time"))).alias("error_code"),
                 F.max_by("error_message", F.when(failed, F.col("completed_time"))).alias("error_message")))


def signal_bounds(signals: DataFrame, lo: float = -10.0, hi: float = 10.0) -> DataFrame:
    s = F.col("composite_signal_score")
    return signals.agg(F.count(F.lit(1)).alias("total_tickers"),
                       F.count_if((s < lo) | (s > hi)).alias("out_of_bounds"),
                       F.min(s).alias("min_score"), F.max(s).alias("max_score"))


def return_bounds(summary: DataFrame, limit: float = 50.0) -> DataFrame:
    r = F.col("post_earnings_5d_return_pct")
    return summary.agg(F.count(F.lit(1)).alias("total_records"),
                       F.count_if(F.abs(r) > limit).alias("extreme_moves"),
                       F.count_if(r.isNull()).alias("null_returns"))


def quality_scorecard(groups: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One completeness row per (table, key column), ascending by share."""
    parts = []
    for label, (df, col) in groups.items():
        complete = F.count_if(F.col(col).isNotNull())
        parts.append(df.agg(F.count(F.lit(1)).alias("total_rows"), complete.alias("complete_rows"))
                     .select(F.lit(label).alias("metric_group"), "total_rows", "complete_rows",
                             pct("complete_rows", "total_rows", 1).alias("completeness_pct")))
    return _union(parts).orderBy("completeness_pct", "metric_group")


def rolling_average_shift(daily: DataFrame, date_col: str, count_col: str = "daily_count",
                          days: int = 30) -> DataFrame:
    """Trailing ``days``-row average of a daily count versus the previous
    ``days`` rows (runs over one row per day)."""
    w = Window.orderBy(date_col)
    cur = F.avg(F.col(count_col).cast("double")).over(w.rowsBetween(-(days - 1), 0))
    out = daily.withColumn("_avg", cur).withColumn("_prev", F.lag("_avg", days).over(w))
    return out.withColumn("shift_pct", half_up(F.abs(safe_div(F.col("_avg") - F.col("_prev"),
                                                                F.col("_prev"))) * 100.0, 2))
