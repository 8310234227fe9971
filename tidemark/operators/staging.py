"""Staging: typing, cleaning and recency filters of the raw tables.

Recency filters compare a column with a literal date, so Catalyst pushes
them into the Parquet scan (row-group skipping); projections are pruned to
the columns the downstream plan needs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_div


def _since(as_of: _dt.date, years: int) -> Column:
    return F.add_months(F.lit(as_of), -12 * years)


def stg_earnings_calls(raw: DataFrame, as_of: _dt.date, years: int = 3,
                       min_len: int = 50, default_confidence: float = 0.85) -> DataFrame:
    """Trim/upper keys, default the confidence; the length filter sees the
    raw (untrimmed) text, as in the reference."""
    return (raw
            .filter((F.col("call_date") >= _since(as_of, years))
                    & F.col("transcript_text").isNotNull()
                    & (F.length("transcript_text") > min_len))
            .select("call_id",
                    F.upper(F.trim("ticker")).alias("ticker"),
                    "company_name", "call_date", "call_type", "quarter", "fiscal_year",
                    F.trim("speaker_name").alias("speaker_name"),
                    F.trim("speaker_role").alias("speaker_role"),
                    F.trim("transcript_text").alias("transcript_text"),
                    F.coalesce(F.col("confidence_score"),
                               F.lit(default_confidence)).alias("confidence_score"),
                    "_loaded_at"))


def stg_sec_filings(raw: DataFrame, as_of: _dt.date, years: int = 3) -> DataFrame:
    return (raw
            .filter((F.col("filing_date") >= _since(as_of, years))
                    & F.col("section_text").isNotNull())
            .select("filing_id",
                    F.upper(F.trim("ticker")).alias("ticker"),
                    "company_name", "filing_type", "filing_date", "period_end_date",
                    F.year("period_end_date").alias("fiscal_year"),
                    F.quarter("period_end_date").alias("fiscal_quarter"),
                    F.trim("filing_title").alias("filing_title"),
                    F.trim("section_text").alias("section_text"),
                    "item_type", "pages_count", "file_size_kb", "_loaded_at"))


def stg_stock_prices(raw: DataFrame, as_of: _dt.date, years: int = 3) -> DataFrame:
    """Adds the intraday return fraction (close-open)/open and dollar volume."""
    return (raw
            .filter(F.col("price_date") >= _since(as_of, years))
            .select("price_id",
                    F.upper(F.trim("ticker")).alias("ticker"),
                    "price_date", "open_price", "high_price", "low_price",
                    "close_price", "adj_close_price", "volume",
                    safe_div(F.col("close_price") - F.col("open_price"),
                             F.col("open_price")).alias("daily_return_pct"),
                    (F.col("volume") * F.col("close_price")).alias("dollar_volume")))


def dedup_latest(df: DataFrame, key, order_col: str, tie: str | None = None) -> DataFrame:
    """Keep the row with the greatest ``order_col`` per key.

    Expressed as ``max_by(struct(row), struct(order, tie))`` in a grouped
    aggregate: the partial aggregate keeps one row per key per map task, so
    even a key holding a third of all rows is reduced before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    order = F.struct(F.col(order_col), *([F.col(tie)] if tie else []))
    latest = (df.groupBy(*[F.col(k) for k in keys])
              .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row")))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in cols])
