"""The model graph: which DataFrame function builds which model from which
inputs, with optional per-model overrides (scenario runs).

Building a model only composes lazy DataFrames; Catalyst sees the whole
plan from the raw scans to the mart at the first action, so filters and
column pruning reach the Parquet scans across model boundaries.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.signals import ts_lit

from ..functions import text as tx
from ..functions.rules import REFERENCE, Lexicon
from ..operators import enrich, indicators, marts, staging

Override = Callable[[DataFrame], DataFrame]

# Upstream models of each model (the dependency edges of the model DAG).
DEPENDS = {
    "stg_earnings_calls": ["earnings_calls"],
    "stg_sec_filings": ["sec_filings"],
    "stg_stock_prices": ["stock_prices"],
    "int_earnings_sentiment": ["stg_earnings_calls"],
    "int_filing_classifications": ["stg_sec_filings"],
    "int_price_metrics": ["stg_stock_prices"],
    "mart_earnings_summary": ["int_earnings_sentiment", "stg_stock_prices"],
    "mart_research_signals": ["int_price_metrics", "int_earnings_sentiment",
                              "int_filing_classifications"],
    "mart_filing_dashboard": ["int_filing_classifications"],
    "ml_sentiment_training": ["int_earnings_sentiment", "stg_stock_prices"],
    "ml_filing_embeddings": ["int_filing_classifications"],
    "dt_earnings_sentiment": ["stg_earnings_calls"],
    "dt_filing_risk_signals": ["int_filing_classifications"],
    "dt_price_summary": ["int_price_metrics"],
}

RAW = ("earnings_calls", "sec_filings", "stock_prices")


def dt_earnings_sentiment(stg: DataFrame, now: _dt.datetime, lex: Lexicon = REFERENCE,
                          role: str = "CEO") -> DataFrame:
    t = F.col("transcript_text")
    return (stg.filter(F.col("speaker_role") == role)
            .select("call_id", "ticker", "company_name", "call_date", "quarter", "fiscal_year",
                    "speaker_name", "speaker_role", "transcript_text",
                    tx.sentiment_neutral(t, lex).alias("sentiment_score"),
                    tx.primary_theme(t, lex).alias("primary_theme"),
                    ts_lit(now).alias("_refreshed_at")))


def dt_filing_risk_signals(cls: DataFrame, now: _dt.datetime) -> DataFrame:
    base = cls.select("ticker", "filing_type", "filing_date", "item_type", "risk_category",
                      "sentiment_polarity", "text_length", "word_count")
    return (indicators.partition_count(base, ["ticker", "filing_date"], "sections_per_filing")
            .select("ticker", "filing_type", "filing_date", "item_type", "risk_category",
                    "sentiment_polarity", "text_length", "word_count", "sections_per_filing",
                    ts_lit(now).alias("_refreshed_at")))


class ModelGraph:
    """Lazily builds models from three raw inputs.

    ``overrides`` maps a model name to a function applied to that model
    after it is built; every downstream model is then derived from the
    overridden frame (a what-if copy that never touches the baseline).
    ``spread`` asks for the rolling-window plan that cuts long tickers.
    """

    def __init__(self, raw: dict[str, DataFrame | Callable[[], DataFrame]], as_of: _dt.date,
                 now: _dt.datetime,
                 lex: Lexicon = REFERENCE, overrides: dict[str, Override] | None = None,
                 spread: bool = False):
        self.raw, self.as_of, self.now, self.lex = raw, as_of, now, lex
        self.overrides = dict(overrides or {})
        self.spread = spread
        self._memo: dict[str, DataFrame] = {}

    def with_overrides(self, overrides: dict[str, Override]) -> "ModelGraph":
        """A scenario copy. Models upstream of (or unrelated to) the new
        overrides are shared with this graph, so baseline and scenario plans
        contain the very same sub-plans (Spark reuses their exchanges)."""
        merged = {**self.overrides, **overrides}
        g = ModelGraph(self.raw, self.as_of, self.now, self.lex, merged, self.spread)
        affected = set(overrides) | {d for o in overrides for d in downstream(o)}
        if "int_price_metrics" in affected:
            affected.add("_latest_metrics")
        g._memo = {k: v for k, v in self._memo.items() if k not in affected}
        return g

    def __getitem__(self, name: str) -> DataFrame:
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        if name not in self._memo:
            df = self._build(name)
            if name in self.overrides:
                df = self.overrides[name](df)
            self._memo[name] = df
        return self._memo[name]

    def _latest_metrics(self) -> DataFrame:
        """One row per ticker: from its last bars only, unless the metrics
        themselves were given (written, or changed by a scenario)."""
        if "_latest_metrics" not in self._memo:
            self._memo["_latest_metrics"] = (
                indicators.latest_per_key(self.get("int_price_metrics"), "ticker", "price_date")
                if "int_price_metrics" in self.overrides else
                indicators.latest_price_metrics(self.get("stg_stock_prices"), spread=self.spread))
        return self._memo["_latest_metrics"]

    def _events(self) -> DataFrame:
        """(ticker, call_date) of all calls, read without their texts."""
        return self.get("stg_earnings_calls").select("ticker", "call_date").distinct()

    def _build(self, name: str) -> DataFrame:
        g, a, n, lex = self.get, self.as_of, self.now, self.lex
        if name in RAW:
            src = self.raw[name]
            return src() if callable(src) else src
        builders = {
            "stg_earnings_calls": lambda: staging.stg_earnings_calls(g("earnings_calls"), a),
            "stg_sec_filings": lambda: staging.stg_sec_filings(g("sec_filings"), a),
            "stg_stock_prices": lambda: staging.stg_stock_prices(g("stock_prices"), a),
            "int_earnings_sentiment": lambda: enrich.int_earnings_sentiment(g("stg_earnings_calls"), lex),
            "int_filing_classifications": lambda: enrich.int_filing_classifications(g("stg_sec_filings"), lex),
            "int_price_metrics": lambda: indicators.int_price_metrics(g("stg_stock_prices"),
                                                                      spread=self.spread),
            "mart_earnings_summary": lambda: marts.mart_earnings_summary(
                g("int_earnings_sentiment"), g("stg_stock_prices"), events=self._events()),
            "mart_research_signals": lambda: marts.mart_research_signals(
                None, g("int_earnings_sentiment"), g("int_filing_classifications"), a, n,
                latest_metrics=self._latest_metrics()),
            "mart_filing_dashboard": lambda: marts.mart_filing_dashboard(g("int_filing_classifications")),
            "ml_sentiment_training": lambda: marts.ml_sentiment_training(
                g("int_earnings_sentiment"), g("stg_stock_prices"), n, events=self._events()),
            "ml_filing_embeddings": lambda: marts.ml_filing_embeddings(g("int_filing_classifications"), n),
            "dt_earnings_sentiment": lambda: dt_earnings_sentiment(g("stg_earnings_calls"), n, lex),
            "dt_filing_risk_signals": lambda: dt_filing_risk_signals(g("int_filing_classifications"), n),
            "dt_price_summary": lambda: indicators.dt_price_summary(self._latest_metrics(), n),
        }
        if name not in builders:
            raise KeyError(f"unknown model {name!r}")
        return builders[name]()


def downstream(name: str) -> list[str]:
    """All models that (transitively) depend on ``name``, in build order."""
    out: list[str] = []
    frontier = [name]
    while frontier:
        cur = frontier.pop(0)
        for m, deps in DEPENDS.items():
            if cur in deps and m not in out:
                out.append(m)
                frontier.append(m)
    return topo_order(out)


def topo_order(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(m):
        for d in DEPENDS.get(m, []):
            if d in names:
                visit(d)
        if m not in order:
            order.append(m)
    for m in names:
        visit(m)
    return order


def graph_from_driver(spark, sf_dir: str, lex: Lexicon, as_of=None, now=None,
                      spread: bool = False) -> ModelGraph:
    from ..sources import adapters as ad
    t = ad.DriverTables(spark, sf_dir)
    raw = {"earnings_calls": lambda: t.earnings_calls, "sec_filings": lambda: t.sec_filings,
           "stock_prices": lambda: t.stock_prices}
    return ModelGraph(raw, as_of or ad.AS_OF, now or ad.NOW, lex, spread=spread)
