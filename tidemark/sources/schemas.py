"""Declared schemas of the raw domain tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, DB, I, L = (T.StringType(), T.DateType(), T.TimestampNTZType(),
                      T.DoubleType(), T.IntegerType(), T.LongType())


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


EARNINGS_CALLS = T.StructType([
    _f("call_id", S, False), _f("ticker", S, False), _f("company_name", S),
    _f("call_date", D, False), _f("call_type", S), _f("quarter", I),
    _f("fiscal_year", I), _f("speaker_name", S), _f("speaker_role", S),
    _f("transcript_text", S), _f("confidence_score", DB), _f("_loaded_at", TS),
])

SEC_FILINGS = T.StructType([
    _f("filing_id", S, False), _f("ticker", S, False), _f("company_name", S),
    _f("filing_type", S), _f("filing_date", D, False), _f("period_end_date", D),
    _f("filing_title", S), _f("section_text", S), _f("item_type", S),
    _f("pages_count", L), _f("file_size_kb", L), _f("_loaded_at", TS),
])

STOCK_PRICES = T.StructType([
    _f("price_id", S, False), _f("ticker", S, False), _f("price_date", D, False),
    _f("open_price", DB), _f("high_price", DB), _f("low_price", DB),
    _f("close_price", DB), _f("adj_close_price", DB), _f("volume", L),
    _f("_loaded_at", TS),
])

EVENT_LOG = T.StructType([
    _f("event_id", S), _f("event_type", S, False), _f("event_time", TS),
    _f("details", S), _f("records_affected", L),
])

# Expected raw column list of earnings_calls (schema-drift monitor), fixed values.
EARNINGS_CALLS_EXPECTED_COLUMNS = [
    "CALL_ID", "TICKER", "COMPANY_NAME", "CALL_DATE", "CALL_TYPE",
    "QUARTER", "FISCAL_YEAR", "SPEAKER_NAME", "SPEAKER_ROLE",
    "TRANSCRIPT_TEXT", "CONFIDENCE_SCORE", "_LOADED_AT",
]

# Column defaults applied at ingest (fixed values; "now" is the load time).
EARNINGS_DEFAULTS = {"confidence_score": 0.85, "_loaded_at": "now"}
FILINGS_DEFAULTS = {"_loaded_at": "now"}
PRICES_DEFAULTS = {"_loaded_at": "now"}

BY_NAME = {
    "earnings_calls": EARNINGS_CALLS,
    "sec_filings": SEC_FILINGS,
    "stock_prices": STOCK_PRICES,
    "event_log": EVENT_LOG,
}
