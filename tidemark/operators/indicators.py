"""Per-ticker time-series indicators and window utilities.

Rolling frames are ROWS frames per ticker ordered by date. Two physical
strategies compute exactly the same values:

* ``spread=False`` (default): one ``Window.partitionBy(ticker)``; all frames
  share a single Exchange + Sort. One bar per ticker and day and the 3-year
  staging filter bound a ticker at about 1,100 rows, whatever the table size.
* ``spread=True`` (on request, for long or intraday histories): a hot ticker is cut into runs of consecutive months
  (about ``run_rows`` rows each, decided on the small table of row counts
  per (ticker, month)); every run also receives the months just before it
  that hold its ``max_preceding`` halo rows, so each run computes its frames
  independently in its own task and no task holds a whole ticker. Only one
  full-data shuffle, as in the plain plan.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, safe_div
from ..functions.signals import technical_signal, ts_lit

# A frame spec: (output name, builder(window) -> Column)
FrameSpec = tuple[str, Callable[[Window], Column]]


def _run_plan(df: DataFrame, key: str, order: str, max_preceding: int, run_rows: int,
              grain: str) -> DataFrame:
    """Per (key, time bucket) of the hot keys: the run that owns its rows and
    the runs that also need them as halo. Computed on the small
    bucket-count table only; keys with at most ``run_rows`` rows are left
    out (one run), so the plan stays tiny and is broadcast by AQE.

    Runs are groups of whole buckets (a bucket = ``grain`` of the order
    column) whose starting row position falls in the same ``run_rows``
    stretch. A bucket is halo for every later run that starts less than
    ``max_preceding`` rows after the bucket ends; such runs start within the
    next ``max_preceding`` buckets, so a bounded frame collects them.
    """
    bucket = F.date_trunc(grain, F.col(order).cast("timestamp_ntz"))
    counts = df.groupBy(key, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    # only keys longer than one run need a plan; every other key is run 0
    hot = (counts.withColumn("_total", F.sum("_n").over(Window.partitionBy(key)))
           .filter(F.col("_total") > run_rows).drop("_total"))
    w = Window.partitionBy(key).orderBy("_bucket")
    b = (hot
         .withColumn("_start", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                          F.lit(0)))
         .withColumn("_run", F.floor(F.col("_start") / run_rows))
         .withColumn("_first", F.col("_run") != F.coalesce(F.lag("_run").over(w), F.lit(-1))))
    ahead = F.collect_list(F.struct("_start", "_run", "_first")).over(w.rowsBetween(1, max_preceding))
    end_plus = F.col("_start") + F.col("_n") + F.lit(max_preceding)
    halo_runs = F.transform(F.filter(ahead, lambda x: x["_first"] & (x["_start"] < end_plus)),
                            lambda x: x["_run"])
    return b.select(key, "_bucket", F.col("_run").alias("_own"),
                    F.array_union(F.array(F.col("_run")), halo_runs).alias("_runs"))


def rolling(df: DataFrame, key: str, order: str, specs: Sequence[FrameSpec],
            max_preceding: int, spread: bool = False, tie: str | None = None,
            run_rows: int = 100_000, grain: str = "month") -> DataFrame:
    """Add rolling-frame columns (frames end at the current row)."""
    if not spread:
        base = Window.partitionBy(key).orderBy(F.col(order), *([F.col(tie)] if tie else []))
        return df.select("*", *[build(base).alias(name) for name, build in specs])
    plan = _run_plan(df, key, order, max_preceding, run_rows, grain)
    bucket = F.date_trunc(grain, F.col(order).cast("timestamp_ntz"))
    exploded = (df.withColumn("_bucket", bucket).join(plan, [key, "_bucket"], "left")
                .withColumn("_own", F.coalesce(F.col("_own"), F.lit(0).cast("bigint")))
                .withColumn("_run", F.explode(F.coalesce(F.col("_runs"), F.array(F.lit(0).cast("bigint"))))))
    w = Window.partitionBy(key, "_run").orderBy(F.col(order), *([F.col(tie)] if tie else []))
    out = exploded.select("*", *[build(w).alias(name) for name, build in specs])
    return (out.filter(F.col("_run") == F.col("_own"))
            .drop("_bucket", "_own", "_runs", "_run"))


def moving_avg(n: int, value: str = "close_price") -> Callable[[Window], Column]:
    return lambda w: F.avg(value).over(w.rowsBetween(-(n - 1), 0))


def rounded_avg(avg: str, digits: int) -> Column:
    """A windowed average rounded for output. Engines add up a frame in
    different orders, so the last bits are rounded away before the digits."""
    return half_up(half_up(avg, 10), digits)


def rolling_stddev(n: int, value: str = "daily_return_pct") -> Callable[[Window], Column]:
    return lambda w: F.stddev_samp(value).over(w.rowsBetween(-(n - 1), 0))


def price_frames(prices: DataFrame, short: int = 20, long: int = 50, vol: int = 20,
                 spread: bool = False, run_rows: int = 100_000) -> DataFrame:
    """Unrounded ma_short, ma_long, volatility per bar."""
    specs = [("_ma_s", moving_avg(short)), ("_ma_l", moving_avg(long)),
             ("_vol", rolling_stddev(vol))]
    cols = ["ticker", "price_date", "price_id", "close_price", "volume",
            "dollar_volume", "daily_return_pct"]
    return rolling(prices.select(*cols), "ticker", "price_date", specs,
                   max(short, long, vol) - 1, spread=spread, tie="price_id", run_rows=run_rows)


def int_price_metrics(stg_prices: DataFrame, short: int = 20, long: int = 50,
                      spread: bool = False, run_rows: int = 100_000) -> DataFrame:
    f = price_frames(stg_prices, short, long, short, spread=spread, run_rows=run_rows)
    return (f.filter(F.col("_ma_l").isNotNull())
            .select("ticker", "price_date", "close_price", "volume", "dollar_volume",
                    "daily_return_pct",
                    rounded_avg("_ma_s", 4).alias(f"ma_{short}d"),
                    rounded_avg("_ma_l", 4).alias(f"ma_{long}d"),
                    half_up(safe_div("_ma_s", "_ma_l"), 6).alias(f"ma_ratio_{short}_{long}"),
                    half_up("_vol", 6).alias(f"volatility_{short}d"),
                    half_up(safe_div("daily_return_pct", "_vol"), 4).alias("sharpe_like_ratio")))


def prev_value(df: DataFrame, value: str = "close_price", key: str = "ticker",
               order: str = "price_date", out: str = "prev_close", spread: bool = False,
               tie: str | None = None) -> DataFrame:
    """LAG(value) per key by order; ``spread`` cuts hot keys into runs with
    a one-row halo, like the rolling frames."""
    if not spread:
        w = Window.partitionBy(key).orderBy(F.col(order), *([F.col(tie)] if tie else []))
        return df.withColumn(out, F.lag(value).over(w))
    return rolling(df, key, order, [(out, lambda w: F.lag(value).over(w))], 1, spread=True, tie=tie)


def latest_per_key(df: DataFrame, key, order: str, tie: str | None = None) -> DataFrame:
    """The row with the greatest ``order`` (then ``tie``) per key.

    ``max_by`` over a struct is partially aggregated on the map side, so the
    shuffle carries at most one row per key per task, whatever the skew.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    kinds = dict(df.dtypes)
    fixed = lambda c: kinds[c] in ("int", "bigint", "double", "float", "date", "timestamp", "timestamp_ntz", "boolean")
    if tie is None and fixed(order) and all(fixed(c) for c in cols if c not in keys):
        # fixed-width buffers: a hash aggregate, no sort
        rest = [c for c in cols if c not in keys and c != order]
        best = df.groupBy(*keys).agg(F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in rest])
        return best.select(*cols)
    ordering = F.struct(F.col(order), *([F.col(tie)] if tie else []))
    best = (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ordering).alias("_r")))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in cols])


def last_n_per_key(df: DataFrame, n: int, key: str = "ticker", order: str = "price_date",
                   tie: str | None = "price_id") -> DataFrame:
    """The last ``n`` rows of every key.

    ``row_number() <= n`` is planned as a WindowGroupLimit: every map task
    keeps at most ``n`` rows per key before the shuffle, so a hot key sends
    n rows per task, not all of its rows.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).desc(), *([F.col(tie).desc()] if tie else []))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest_price_metrics(stg_prices: DataFrame, short: int = 20, long: int = 50,
                         spread: bool = False) -> DataFrame:
    """Latest row of ``int_price_metrics`` per ticker without windowing the
    whole history.

    The latest bar's frames reach back ``long`` rows at most, so its values
    come from each ticker's last ``long`` bars. Exactness fallback: when all
    closes of those bars are NULL the metrics model drops the latest bar and
    the latest surviving row is older, so only those tickers (normally none)
    are recomputed over their full history.
    """
    recent = last_n_per_key(stg_prices, max(short, long))
    fast = latest_per_key(int_price_metrics(recent, short, long), "ticker", "price_date")
    # tickers whose recent closes are all NULL (their latest bar has no long average)
    missing = (recent.groupBy("ticker").agg(F.count("close_price").alias("_n"))
               .filter(F.col("_n") == 0).select("ticker"))
    slow_input = stg_prices.join(missing, "ticker", "left_semi")
    slow = latest_per_key(int_price_metrics(slow_input, short, long, spread=spread),
                          "ticker", "price_date")
    return fast.unionByName(slow)


def dt_price_summary_from_bars(stg_prices: DataFrame, now: _dt.datetime, short: int = 20,
                               long: int = 50) -> DataFrame:
    """Same rows as ``dt_price_summary(int_price_metrics(stg))``, from each
    ticker's last ``long`` bars (see ``latest_price_metrics``)."""
    return dt_price_summary(latest_price_metrics(stg_prices, short, long), now)


def dt_price_summary(metrics: DataFrame, now: _dt.datetime) -> DataFrame:
    """Latest bar per ticker with indicators and the technical signal."""
    latest = latest_per_key(metrics, "ticker", "price_date")
    return latest.select(
        "ticker", "price_date", "close_price", "volume", "dollar_volume",
        "daily_return_pct", "ma_20d", "ma_50d", "ma_ratio_20_50", "volatility_20d",
        "sharpe_like_ratio",
        technical_signal("ma_ratio_20_50", "daily_return_pct").alias("technical_signal"),
        ts_lit(now).alias("_refreshed_at"))


def partition_count(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """COUNT(*) OVER (PARTITION BY keys) as aggregate + join.

    The count is partially aggregated, and the join back keys on the group
    (AQE broadcasts the count table when its measured size is small, and
    splits a skewed key's partition otherwise).
    """
    counts = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias(out))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]      # a NULL key is a group
    return df.join(counts, reduce(lambda a, b: a & b, same)).select(*df.columns, out)


def share_of_total(df: DataFrame, key: str, count_col: str = "record_count",
                   pct_col: str = "pct_of_total", digits: int = 2) -> DataFrame:
    """Count per group and its percentage of all rows.

    The unpartitioned window runs after aggregation, over one row per group.
    """
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    total = F.sum(count_col).over(Window.partitionBy())
    return g.withColumn(pct_col, half_up(safe_div(F.col(count_col).cast("double") * 100.0,
                                                  total), digits))


def rolling_group_count(df: DataFrame, date_col: str, n: int = 7,
                        count_col: str = "daily_count") -> DataFrame:
    """Daily counts with a trailing n-row average and the ratio to it.

    Runs over one row per day after a partially aggregated count.
    """
    g = df.groupBy(date_col).agg(F.count(F.lit(1)).alias(count_col))
    w = Window.orderBy(date_col).rowsBetween(-(n - 1), 0)
    avg = F.avg(F.col(count_col).cast("double")).over(w)
    return (g.withColumn("rolling_7d_avg" if n == 7 else f"rolling_{n}d_avg", avg)
            .withColumn("volume_ratio", safe_div(F.col(count_col).cast("double"), avg)))
