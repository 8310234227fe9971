"""Derive the three raw domain tables (and helper inputs) from the shared
driver tables.

All adapters are single-pass, partition-parallel projections or
partially-aggregated ``groupBy``s, so their cost grows linearly with the
input; no adapter samples or caps rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.signals import ts_lit

# Evaluation clock used with the driver tables (fixed values).
AS_OF = _dt.date(2024, 1, 31)
NOW = _dt.datetime(2024, 1, 31, 12, 0, 0)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prices_from_events(events: DataFrame) -> DataFrame:
    """Daily OHLCV bars per user (ticker) from the ``events`` stream.

    One aggregation keyed by (user, day); ``min_by``/``max_by`` on the event
    time give open/close and merge in the map-side partial aggregate, so a
    hot user never funnels its raw rows through one task.
    """
    day = F.to_date("ts")
    bars = (events
            .groupBy("user_id", day.alias("price_date"))
            .agg(F.min_by("value", "ts").alias("open_price"),
                 F.max("value").alias("high_price"),
                 F.min("value").alias("low_price"),
                 F.max_by("value", "ts").alias("close_price"),
                 F.count(F.lit(1)).alias("volume"),
                 F.max("ts").alias("_loaded_at")))
    return bars.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("-"),
                 F.col("price_date").cast("string")).alias("price_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        "price_date", "open_price", "high_price", "low_price", "close_price",
        F.col("close_price").alias("adj_close_price"),
        F.col("volume").cast("bigint").alias("volume"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
    )


def calls_from_conversations(conv: DataFrame) -> DataFrame:
    """One earnings-call row per conversation turn (15 tickers: hot keys)."""
    tk = (F.col("conv_id") % 15).cast("string")
    role = F.col("role")
    return conv.select(
        F.concat(F.lit("EC-"), F.col("conv_id").cast("string"), F.lit("-"),
                 F.col("turn").cast("string")).alias("call_id"),
        F.concat(F.lit("U"), tk).alias("ticker"),
        F.concat(F.lit("Company "), tk).alias("company_name"),
        F.date_add(F.lit(_dt.date(2024, 1, 1)),
                   ((F.col("conv_id") * 7 + F.col("turn") * 3) % 25).cast("int")).alias("call_date"),
        F.lit("earnings").alias("call_type"),
        F.lit(1).alias("quarter"),
        F.lit(2024).alias("fiscal_year"),
        role.alias("speaker_name"),
        F.when(role == "user", "CEO").when(role == "assistant", "CFO")
         .otherwise("IR").alias("speaker_role"),
        F.col("text").alias("transcript_text"),
        F.when(F.col("turn") % 3 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(0.9)).alias("confidence_score"),
        ts_lit(_dt.datetime(2024, 1, 31)).alias("_loaded_at"),
    )


def filings_from_documents(docs: DataFrame) -> DataFrame:
    """One filing section per document (even tickers only)."""
    d = F.col("doc_id")
    fdate = F.date_add(F.lit(_dt.date(2023, 11, 2)), (d % 91).cast("int"))
    return docs.select(
        F.concat(F.lit("SF-"), d.cast("string")).alias("filing_id"),
        F.concat(F.lit("U"), ((d * 2) % 150).cast("string")).alias("ticker"),
        F.col("source").alias("company_name"),
        F.when(d % 4 == 0, "10-K").when(d % 4 == 3, "8-K").otherwise("10-Q").alias("filing_type"),
        fdate.alias("filing_date"),
        fdate.alias("period_end_date"),
        F.col("lang").alias("filing_title"),
        F.col("text").alias("section_text"),
        F.col("source").alias("item_type"),
        (F.lit(1) + F.floor(F.col("n_chars") / 3000)).cast("bigint").alias("pages_count"),
        (F.lit(1) + F.floor(F.col("n_chars") / 100)).cast("bigint").alias("file_size_kb"),
        ts_lit(_dt.datetime(2024, 1, 31)).alias("_loaded_at"),
    )


def vectors_from_embeddings(emb: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) from the float embeddings table."""
    return emb.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))


# Version boundaries of the keyed CDC fixture (fixed values).
CDC_BEFORE_UNTIL = _dt.datetime(2001, 1, 1)    # the older version lacks the newest orders
CDC_AFTER_FROM = _dt.datetime(1995, 7, 1)      # the newer version lacks the oldest orders


def cdc_pair_from_orders(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two versions of one keyed table, both derived from all of ``orders``.

    ``before`` is the table as of an earlier load (no orders dated from
    2001 on); ``after`` is a later load in which orders before mid-1995 were
    purged and open orders were re-priced: the diff exercises inserts,
    deletes and updates across the whole table.
    """
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    day = F.col("o_orderdate").cast("timestamp_ntz")
    before = orders.filter(day < ts_lit(CDC_BEFORE_UNTIL)).select(*cols)
    after = (orders.filter(day >= ts_lit(CDC_AFTER_FROM)).select(*cols)
             .withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1)
                         .otherwise(F.col("o_totalprice"))))
    return before, after


def refresh_log_from_events(events: DataFrame) -> DataFrame:
    """A task/refresh run log: one run per event (name = event_type)."""
    return events.select(
        F.col("event_type").alias("name"),
        F.col("ts").cast("timestamp_ntz").alias("completed_time"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("E"), F.col("event_id").cast("string"))).alias("error_code"),
    )


class DriverTables:
    """Lazy accessors for the domain tables derived from one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    @property
    def stock_prices(self) -> DataFrame:
        return prices_from_events(self.raw("events"))

    @property
    def earnings_calls(self) -> DataFrame:
        return calls_from_conversations(self.raw("conversations"))

    @property
    def sec_filings(self) -> DataFrame:
        return filings_from_documents(self.raw("documents"))

    @property
    def vectors(self) -> DataFrame:
        return vectors_from_embeddings(self.raw("embeddings"))

    def cdc_pair(self) -> tuple[DataFrame, DataFrame]:
        return cdc_pair_from_orders(self.raw("orders"))

    @property
    def run_log(self) -> DataFrame:
        return refresh_log_from_events(self.raw("events"))
