"""
DuckDB ``oracle_sql``.

Every query reads the driver tables of ``sf_dir`` (through the adapters in
``tidemark.sources.adapters``) and runs over all their rows. Side-effecting
operators (sinks, layouts, CSV load, streams) write to a fresh folder under
the session's ``spark.checkpoint.dir`` and return what they read back, so
their oracle is the SQL of the same content.
"""

from __future__ import annotations

import datetime as _dt
import importlib
import os
import re
import sys
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

# importable however this file is loaded (by module name or by file path)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries as oq
from oracle_queries import AS_OF as SQL_AS_OF, NOW as SQL_NOW, hu, sql
from tidemark.functions import text as tx
from tidemark.functions.numeric import half_up
from tidemark.functions.rules import FIXTURE, REFERENCE
from tidemark.functions.signals import technical_signal, ts_lit
from tidemark.operators import (alerts, cdc, embeddings, enrich, gated, governance as gov, indicators,
                                joins, marts, monitor, policies_sql, profiles, quality, retrieval, scenario, similarity, staging,
                                text_models)
from tidemark.plans.graph import graph_from_driver
from tidemark.plans.pipeline import GROUPS, raw_inputs, run_pipeline
from tidemark.session import drop_scratch, ensure_checkpoint_dir, scratch_path
from tidemark.sources import adapters as ad
from tidemark.sources import files, schemas, sinks
from tidemark.streaming import cdc_stream, progress, refresh
from tidemark.streaming.store import PartitionedTable

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF, NOW = ad.AS_OF, ad.NOW

_REG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

# The two versions of the keyed CDC fixture (see adapters.cdc_pair_from_orders).
_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
_BEFORE_SQL = f"SELECT {_ORDER_COLS} FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'"
_AFTER_SQL = (f"SELECT o_orderkey, o_custkey, o_orderstatus, "
              f"CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
              f"o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01 00:00:00'")


def register(name: str, sql_text: str | None):
    def deco(fn):
        _REG[name] = (fn, sql_text)
        return fn
    return deco


def G(spark, sf_dir, lex=FIXTURE):
    """The model graph over one input folder."""
    return graph_from_driver(spark, sf_dir, lex)


def T(spark, sf_dir):
    return ad.DriverTables(spark, sf_dir)


def union_all(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


# ======================================================================
# 2.2 - 2.5 models (staging, intermediates, marts, refreshed tables)
# ======================================================================
def _model_query(name: str, lex=FIXTURE):
    return lambda spark, sf_dir: G(spark, sf_dir, lex).get(name)


for _name in ["stg_earnings_calls", "stg_sec_filings", "stg_stock_prices",
              "int_earnings_sentiment", "int_filing_classifications", "int_price_metrics",
              "mart_earnings_summary", "mart_filing_dashboard", "ml_sentiment_training",
              "dt_earnings_sentiment", "dt_filing_risk_signals", "dt_price_summary"]:
    register(_name, oq.model(_name))(_model_query(_name))

_COUNTS_AS_DOUBLE = ("SELECT * REPLACE (CAST(total_risk_flags AS DOUBLE) AS total_risk_flags, "
                     "CAST(high_risk_count AS DOUBLE) AS high_risk_count) FROM mart_research_signals")


def _counts_as_double(df: DataFrame) -> DataFrame:
    """Nullable counts compared as double (pandas has no common null int)."""
    return df.withColumns({c: df[c].cast("double") for c in ("total_risk_flags", "high_risk_count")})


@register("mart_research_signals", sql(_COUNTS_AS_DOUBLE, "mart_research_signals"))
def _mart_research_signals(spark, sf_dir):
    return _counts_as_double(G(spark, sf_dir).get("mart_research_signals"))


def _flat_embeddings(df: DataFrame) -> DataFrame:
    keep = [c for c in df.columns if c not in ("embedding_vector", "_embedded_at")]
    return df.select(*keep, *[F.col("embedding_vector")[i].alias(f"emb_{i + 1}") for i in range(5)],
                     "_embedded_at")


@register("ml_filing_embeddings", oq.model("ml_filing_embeddings"))
def _ml_filing_embeddings(spark, sf_dir):
    return _flat_embeddings(G(spark, sf_dir).get("ml_filing_embeddings"))


@register("int_price_metrics_spread", oq.model("int_price_metrics"))
def _int_price_metrics_spread(spark, sf_dir):
    """The plan that cuts long tickers into runs (here of ten bars) gives the same rows."""
    return indicators.int_price_metrics(G(spark, sf_dir).get("stg_stock_prices"), spread=True, run_rows=10)


@register("int_price_metrics_plain", oq.model("int_price_metrics"))
def _int_price_metrics_plain(spark, sf_dir):
    """The one-partition-per-ticker plan, built outside the graph."""
    return indicators.int_price_metrics(G(spark, sf_dir).get("stg_stock_prices"), spread=False)


@register("stg_dedup", f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, _loaded_at FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _loaded_at DESC) AS rn FROM (
        SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS _loaded_at FROM ({_BEFORE_SQL}) b
        UNION ALL
        SELECT *, TIMESTAMP '2024-01-02 00:00:00' AS _loaded_at FROM ({_AFTER_SQL}) a))
    WHERE rn = 1""")
def _stg_dedup(spark, sf_dir):
    """Two loads of the same keyed table; keep the latest row per key."""
    before, after = T(spark, sf_dir).cdc_pair()
    loads = (before.withColumn("_loaded_at", ts_lit(_dt.datetime(2024, 1, 1)))
             .unionByName(after.withColumn("_loaded_at", ts_lit(_dt.datetime(2024, 1, 2)))))
    return staging.dedup_latest(loads, "o_orderkey", "_loaded_at")


# ======================================================================
# 2.3 text scoring
# ======================================================================
def _stg_calls(spark, sf_dir):
    return G(spark, sf_dir).get("stg_earnings_calls")


def _stg_filings(spark, sf_dir):
    return G(spark, sf_dir).get("stg_sec_filings")


_T, _S = "transcript_text", "section_text"


@register("text_sentiment_score", sql(
    f"SELECT call_id, {oq.sentiment_sql(_T, 'call_id', FIXTURE)} AS sentiment_score FROM stg_earnings_calls",
    "stg_earnings_calls"))
def _text_sentiment_score(spark, sf_dir):
    return _stg_calls(spark, sf_dir).select(
        "call_id", tx.sentiment_score(F.col(_T), "call_id", FIXTURE).alias("sentiment_score"))


@register("text_sentiment_score_reference_lexicon", sql(
    f"SELECT call_id, {oq.sentiment_sql(_T, 'call_id', REFERENCE)} AS sentiment_score FROM stg_earnings_calls",
    "stg_earnings_calls"))
def _text_sentiment_score_ref(spark, sf_dir):
    """Default (reference) lexicon: the driver prose hits the hash fallback."""
    return _stg_calls(spark, sf_dir).select(
        "call_id", tx.sentiment_score(F.col(_T), "call_id", REFERENCE).alias("sentiment_score"))


@register("text_sentiment_neutral", sql(
    f"SELECT call_id, {oq.sentiment_sql(_T, None, FIXTURE)} AS sentiment_score "
    "FROM stg_earnings_calls WHERE speaker_role = 'CEO'", "stg_earnings_calls"))
def _text_sentiment_neutral(spark, sf_dir):
    return (_stg_calls(spark, sf_dir).filter(F.col("speaker_role") == "CEO")
            .select("call_id", tx.sentiment_neutral(F.col(_T), FIXTURE).alias("sentiment_score")))


@register("text_theme_summary", sql(
    f"SELECT call_id, {oq.summary_sql(_T, FIXTURE)} AS ai_summary FROM stg_earnings_calls",
    "stg_earnings_calls"))
def _text_theme_summary(spark, sf_dir):
    return _stg_calls(spark, sf_dir).select("call_id", tx.theme_summary(F.col(_T), FIXTURE).alias("ai_summary"))


@register("text_primary_theme", sql(
    f"SELECT call_id, {oq.theme_sql(_T, FIXTURE)} AS primary_theme FROM stg_earnings_calls",
    "stg_earnings_calls"))
def _text_primary_theme(spark, sf_dir):
    return _stg_calls(spark, sf_dir).select("call_id", tx.primary_theme(F.col(_T), FIXTURE).alias("primary_theme"))


@register("text_risk_category", sql(
    f"SELECT filing_id, {oq.risk_sql(_S, FIXTURE)} AS risk_category FROM stg_sec_filings",
    "stg_sec_filings"))
def _text_risk_category(spark, sf_dir):
    return _stg_filings(spark, sf_dir).select("filing_id", tx.risk_category(F.col(_S), FIXTURE).alias("risk_category"))


@register("text_risk_category_reference_lexicon", sql(
    f"SELECT filing_id, {oq.risk_sql(_S, REFERENCE)} AS risk_category, "
    f"{oq.polarity_sql(_S, REFERENCE)} AS sentiment_polarity FROM stg_sec_filings", "stg_sec_filings"))
def _text_risk_category_ref(spark, sf_dir):
    return _stg_filings(spark, sf_dir).select(
        "filing_id", tx.risk_category(F.col(_S), REFERENCE).alias("risk_category"),
        tx.polarity(F.col(_S), REFERENCE).alias("sentiment_polarity"))


@register("text_polarity", sql(
    f"SELECT filing_id, {oq.polarity_sql(_S, FIXTURE)} AS sentiment_polarity FROM stg_sec_filings",
    "stg_sec_filings"))
def _text_polarity(spark, sf_dir):
    return _stg_filings(spark, sf_dir).select("filing_id", tx.polarity(F.col(_S), FIXTURE).alias("sentiment_polarity"))


@register("text_stats", sql(
    "SELECT filing_id, CAST(length(section_text) AS BIGINT) AS text_length, "
    "CAST(len(regexp_extract_all(section_text, '\\w+')) AS BIGINT) AS word_count FROM stg_sec_filings",
    "stg_sec_filings"))
def _text_stats(spark, sf_dir):
    return _stg_filings(spark, sf_dir).select(
        "filing_id", tx.text_length(F.col(_S)).alias("text_length"), tx.word_count(F.col(_S)).alias("word_count"))


@register("text_model_score", sql(
    f"SELECT call_id, {oq.sentiment_sql(_T, 'call_id', FIXTURE)} AS model_score FROM stg_earnings_calls",
    "stg_earnings_calls"))
def _text_model_score(spark, sf_dir):
    """Pluggable scorer; the default is the JVM-side rule compiler."""
    df = enrich.score_with_model(_stg_calls(spark, sf_dir), _T, "model_score",
                                 enrich.rule_scorer(FIXTURE), key_col="call_id")
    return df.select("call_id", "model_score")


_SENT = r"[.!?]+\s+|\n+"


@register("text_model_summary", sql(f"""
    WITH t AS (SELECT call_id, transcript_text, list_filter(string_split_regex(transcript_text, '{_SENT}'), lambda x: regexp_matches(x, '\\w')) AS ss
               FROM stg_earnings_calls),
    s AS (SELECT call_id, place, ss[place + 1] AS sentence FROM (SELECT call_id, ss, unnest(range(len(ss))) AS place FROM t)),
    w AS (SELECT call_id, place, word, count(*) AS n FROM (
            SELECT call_id, place, unnest(regexp_extract_all(lower(sentence), '\\w+')) AS word FROM s) GROUP BY ALL),
    tf AS (SELECT call_id, word, sum(n) AS tf FROM w GROUP BY ALL),
    df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
    weighed AS (SELECT call_id, word, tf * CAST(round(1000 * ln(((SELECT count(transcript_text) FROM t) + 1) / df)) AS BIGINT) AS x
                FROM tf JOIN df USING (word)),
    scored AS (SELECT call_id, place, CAST(sum(x) AS DOUBLE) / count(*) AS weight FROM w JOIN weighed USING (call_id, word) GROUP BY ALL),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY weight DESC, place) <= 2),
    joined AS (SELECT call_id, string_agg(sentence, ' ' ORDER BY place) AS summary FROM best JOIN s USING (call_id, place) GROUP BY call_id)
    SELECT t.call_id, CASE WHEN t.transcript_text IS NOT NULL THEN coalesce(joined.summary, '') END AS summary
    FROM t LEFT JOIN joined ON joined.call_id = t.call_id""", "stg_earnings_calls"))
def _text_model_summary(spark, sf_dir):
    """Extractive summaries: the two sentences of each transcript whose words weigh most."""
    return text_models.extractive_summary(_stg_calls(spark, sf_dir), "call_id", _T)


@register("text_model_sentiment", None)
def _text_model_sentiment(spark, sf_dir):
    """A classifier fitted on the transcripts that the lexicon calls positive or negative, applied to all."""
    calls = _stg_calls(spark, sf_dir)
    score = tx.sentiment_neutral(F.col(_T), FIXTURE)
    labelled = calls.select("call_id", _T, F.when(score > 0, 1).when(score < 0, 0).alias("label"))
    return text_models.model_sentiment(calls, text_models.fit_sentiment(labelled, "call_id", _T, "label"), "call_id", _T)


# ======================================================================
# 2.4 windows
# ======================================================================
_W = "PARTITION BY ticker ORDER BY price_date, price_id ROWS BETWEEN {n} PRECEDING AND CURRENT ROW"


def _sql_avg(n):
    return hu(f"avg(close_price) OVER ({_W.format(n=n - 1)})", 10)


def _rounded(c, d, name):
    return half_up(c, d).alias(name)


def _bars(spark, sf_dir):
    return G(spark, sf_dir).get("stg_stock_prices")


@register("win_moving_avg", sql(
    f"SELECT ticker, price_date, {hu(_sql_avg(20), 4)} AS ma_20d, {hu(_sql_avg(50), 4)} AS ma_50d "
    "FROM stg_stock_prices", "stg_stock_prices"))
def _win_moving_avg(spark, sf_dir):
    f = indicators.rolling(_bars(spark, sf_dir), "ticker", "price_date",
                           [("a", indicators.moving_avg(20)), ("b", indicators.moving_avg(50))],
                           49, tie="price_id")
    return f.select("ticker", "price_date", indicators.rounded_avg("a", 4).alias("ma_20d"),
                    indicators.rounded_avg("b", 4).alias("ma_50d"))


@register("win_rolling_volatility", sql(
    f"SELECT ticker, price_date, {hu('stddev_samp(daily_return_pct) OVER (' + _W.format(n=19) + ')', 6)} "
    "AS volatility_20d FROM stg_stock_prices", "stg_stock_prices"))
def _win_rolling_volatility(spark, sf_dir):
    f = indicators.rolling(_bars(spark, sf_dir), "ticker", "price_date",
                           [("v", indicators.rolling_stddev(20))], 19, tie="price_id")
    return f.select("ticker", "price_date", _rounded("v", 6, "volatility_20d"))


@register("win_prev_close", sql(
    "SELECT ticker, price_date, close_price, lag(close_price) OVER (PARTITION BY ticker ORDER BY price_date) "
    "AS prev_close FROM stg_stock_prices", "stg_stock_prices"))
def _win_prev_close(spark, sf_dir):
    return indicators.prev_value(_bars(spark, sf_dir).select("ticker", "price_date", "close_price"))


@register("latest_per_key", sql("""
    SELECT ticker, price_date, close_price, volume FROM (
      SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY price_date DESC) AS rn FROM stg_stock_prices)
    WHERE rn = 1""", "stg_stock_prices"))
def _latest_per_key(spark, sf_dir):
    return indicators.latest_per_key(_bars(spark, sf_dir).select("ticker", "price_date", "close_price", "volume"),
                                     "ticker", "price_date")


@register("technical_signal", sql(
    f"SELECT ticker, price_date, ma_ratio_20_50, daily_return_pct, "
    f"{oq.signal_sql('ma_ratio_20_50', 'daily_return_pct')} AS technical_signal FROM int_price_metrics",
    "int_price_metrics"))
def _technical_signal(spark, sf_dir):
    m = G(spark, sf_dir).get("int_price_metrics")
    return m.select("ticker", "price_date", "ma_ratio_20_50", "daily_return_pct",
                    technical_signal("ma_ratio_20_50", "daily_return_pct").alias("technical_signal"))


@register("win_partition_count", sql(
    "SELECT filing_id, ticker, filing_date, count(*) OVER (PARTITION BY ticker, filing_date) "
    "AS sections_per_filing FROM int_filing_classifications", "int_filing_classifications"))
def _win_partition_count(spark, sf_dir):
    f = G(spark, sf_dir).get("int_filing_classifications").select("filing_id", "ticker", "filing_date")
    return indicators.partition_count(f, ["ticker", "filing_date"], "sections_per_filing")


@register("win_share_of_total", sql(f"""
    SELECT filing_type, count(*) AS record_count,
           {hu('CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE)', 2)} AS pct_of_total
    FROM int_filing_classifications GROUP BY filing_type""", "int_filing_classifications"))
def _win_share_of_total(spark, sf_dir):
    return indicators.share_of_total(G(spark, sf_dir).get("int_filing_classifications"), "filing_type")


@register("win_agg_over_agg", sql("""
    SELECT call_date, count(*) AS daily_count,
           avg(count(*)) OVER (ORDER BY call_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_avg,
           count(*) / avg(count(*)) OVER (ORDER BY call_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
             AS volume_ratio
    FROM earnings_calls GROUP BY call_date""", "earnings_calls"))
def _win_agg_over_agg(spark, sf_dir):
    return indicators.rolling_group_count(T(spark, sf_dir).earnings_calls, "call_date", 7)


# ======================================================================
# 2.5 joins and aggregates
# ======================================================================
@register("join_event_window_left", sql("""
    SELECT e.call_id, e.ticker, e.call_date, p.price_date, p.daily_return_pct
    FROM int_earnings_sentiment e LEFT JOIN stg_stock_prices p
      ON e.ticker = p.ticker AND p.price_date BETWEEN e.call_date AND e.call_date + 5""",
    "int_earnings_sentiment", "stg_stock_prices"))
def _join_event_window_left(spark, sf_dir):
    g = G(spark, sf_dir)
    ev = g.get("int_earnings_sentiment").select("call_id", "ticker", "call_date")
    return joins.event_window_join(ev, g.get("stg_stock_prices"), 0, 5, "left")


@register("join_event_window_inner", sql("""
    SELECT e.call_id, e.ticker, e.call_date, p.price_date, p.daily_return_pct
    FROM int_earnings_sentiment e JOIN stg_stock_prices p
      ON e.ticker = p.ticker AND p.price_date > e.call_date AND p.price_date <= e.call_date + 10""",
    "int_earnings_sentiment", "stg_stock_prices"))
def _join_event_window_inner(spark, sf_dir):
    g = G(spark, sf_dir)
    ev = g.get("int_earnings_sentiment").select("call_id", "ticker", "call_date")
    return joins.event_window_join(ev, g.get("stg_stock_prices"), 1, 10, "inner")


@register("agg_risk_counts", sql("SELECT ticker, flags AS total_risk_flags, severe AS high_risk_count FROM flags_30d", "flags_30d"))
def _agg_risk_counts(spark, sf_dir):
    return marts.risk_counts(G(spark, sf_dir).get("int_filing_classifications"), AS_OF)


@register("ml_sentiment_training_corrected", sql(f"""
    SELECT event_date, ticker, {hu('sentiment_score', 4)} AS sentiment_feature,
           {hu('coalesce(r5, 0.0)', 6)} AS label_5d_return, {hu('coalesce(r10, 0.0)', 6)} AS label_10d_return,
           CASE WHEN r5 > 0.005 THEN 1 ELSE 0 END AS label_positive_5d,
           CASE WHEN r5 < -0.005 THEN 1 ELSE 0 END AS label_negative_5d,
           {SQL_NOW} AS _training_snapshot_at
    FROM (SELECT e.ticker, e.call_date AS event_date, e.sentiment_score,
                 avg(CASE WHEN p.price_date <= e.call_date + 5 THEN p.daily_return_pct END) AS r5,
                 avg(p.daily_return_pct) AS r10
          FROM int_earnings_sentiment e JOIN stg_stock_prices p ON e.ticker = p.ticker
               AND p.price_date > e.call_date AND p.price_date <= e.call_date + 10
          GROUP BY 1, 2, 3) t""", "int_earnings_sentiment", "stg_stock_prices"))
def _ml_sentiment_training_corrected(spark, sf_dir):
    g = G(spark, sf_dir)
    return marts.ml_sentiment_training(g.get("int_earnings_sentiment"), g.get("stg_stock_prices"), NOW,
                                       horizons=(5, 10))


@register("ml_text_embeddings", None)
def _ml_text_embeddings(spark, sf_dir):
    """TF-IDF + L2 embeddings of every filing section (rows-only check)."""
    return embeddings.embed_text(_stg_filings(spark, sf_dir), _S, "filing_id", dim=32)


@register("ml_text_embeddings_norms", sql(
    "SELECT filing_id, 32 AS dims, CASE WHEN regexp_matches(coalesce(section_text, ''), '\\w') THEN 1.0 ELSE 0.0 END AS norm FROM stg_sec_filings",
    "stg_sec_filings"))
def _ml_text_embeddings_norms(spark, sf_dir):
    """Latent vectors have length one, those of texts without words are zero."""
    e = _ml_text_embeddings(spark, sf_dir)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return e.select("filing_id", F.size("embedding").alias("dims"), half_up(length, 6).alias("norm"))


# ======================================================================
# 2.6 retrieval, ranking, scenario
# ======================================================================
@register("topk_bullish", sql("""
    SELECT ticker, close_price, ceo_sentiment, composite_signal_score, signal_direction
    FROM mart_research_signals WHERE signal_direction = 'BULLISH'
    ORDER BY composite_signal_score DESC NULLS LAST, ticker LIMIT 10""", "mart_research_signals"))
def _topk_bullish(spark, sf_dir):
    return retrieval.topk_bullish(G(spark, sf_dir).get("mart_research_signals"))


@register("rank_post_earnings_moves", sql("""
    SELECT ticker, sentiment_label, post_earnings_5d_return_pct, prediction_accuracy
    FROM mart_earnings_summary WHERE prediction_accuracy IN ('Accurate Positive', 'Accurate Negative')
    ORDER BY abs(post_earnings_5d_return_pct) DESC""", "mart_earnings_summary"))
def _rank_post_earnings_moves(spark, sf_dir):
    return retrieval.rank_post_earnings(G(spark, sf_dir).get("mart_earnings_summary"))


_COS = ("list_dot_product(a.e, t.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(t.e, t.e)))")


@register("vector_cosine_topk", f"""
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
         t AS (SELECT e FROM v WHERE vec_id = 0)
    SELECT a.vec_id, {hu(_COS, 6)} AS cosine_similarity
    FROM v a, t WHERE a.vec_id <> 0
    ORDER BY {_COS} DESC NULLS LAST, a.vec_id LIMIT 10""")
def _vector_cosine_topk(spark, sf_dir):
    return retrieval.cosine_topk(T(spark, sf_dir).vectors, "vec_id", "embedding", 0, k=10)


# every 100th vector against all vectors
_EVERY = 100


def _targets(spark, sf_dir):
    return T(spark, sf_dir).vectors.filter(F.col("vec_id") % _EVERY == 0)


@register("vector_cosine_topk_all", f"""
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT t.vec_id AS target_id, CAST(row_number() OVER (PARTITION BY t.vec_id ORDER BY {_COS} DESC, a.vec_id) AS INTEGER) AS "rank",
           a.vec_id AS id, {hu(_COS, 6)} AS cosine_similarity
    FROM v a JOIN v t ON t.vec_id % {_EVERY} = 0 AND a.vec_id <> t.vec_id
    QUALIFY "rank" <= 10""")
def _vector_cosine_topk_all(spark, sf_dir):
    """Ten nearest rows of many targets in one plan."""
    return similarity.cosine_topk_all(T(spark, sf_dir).vectors, _targets(spark, sf_dir), "vec_id", "embedding", k=10)


@register("vector_cosine_topk_index", None)
def _vector_cosine_topk_index(spark, sf_dir):
    """The same through the hash index (recall of 0.95 aimed at; tested against the exact search)."""
    index = similarity.build_index(T(spark, sf_dir).vectors, "vec_id", "embedding", cell_rows=512)
    return similarity.index_topk(index, _targets(spark, sf_dir), "vec_id", "embedding", k=10)


_TV = "(SELECT [emb_1, emb_2, emb_3, emb_4, emb_5] FROM ml_filing_embeddings WHERE filing_id = 'SF-0')"
_COS_F = (f"list_dot_product(a.e, {_TV}) / (sqrt(list_dot_product(a.e, a.e)) "
          f"* sqrt(list_dot_product({_TV}, {_TV})))")


@register("vector_cosine_topk_filings", sql(f"""
    SELECT a.filing_id, a.risk_category, {hu(_COS_F, 6)} AS cosine_similarity
    FROM (SELECT filing_id, risk_category, [emb_1, emb_2, emb_3, emb_4, emb_5] AS e
          FROM ml_filing_embeddings) a
    WHERE a.filing_id <> 'SF-0'
    ORDER BY {_COS_F} DESC NULLS LAST, a.filing_id LIMIT 10""", "ml_filing_embeddings"))
def _vector_cosine_topk_filings(spark, sf_dir):
    """The reference's own search: filings similar to one target filing."""
    emb = G(spark, sf_dir).get("ml_filing_embeddings")
    return retrieval.cosine_topk(emb, "filing_id", "embedding_vector", "SF-0", k=10,
                                 extra_cols=("risk_category",))


@register("scenario_clone", f"""
    SELECT 'baseline' AS scenario, * FROM ({sql(_COUNTS_AS_DOUBLE, "mart_research_signals")}) a
    UNION ALL SELECT 'clone', * FROM ({sql(_COUNTS_AS_DOUBLE, "mart_research_signals", ctes=oq.CTES_STRESS)}) b
    UNION ALL SELECT 'baseline after', * FROM ({sql(_COUNTS_AS_DOUBLE, "mart_research_signals")}) c""")
def _scenario_clone(spark, sf_dir):
    """A copy is taken and stressed; the baseline gives the same rows after."""
    base = G(spark, sf_dir)
    before = base.get("mart_research_signals")
    clone = scenario.stress_scenario(scenario.scenario(base, {}), 0.6, -0.2).get("mart_research_signals")
    after = base.get("mart_research_signals")
    return union_all([_counts_as_double(df).select(F.lit(name).alias("scenario"), "*")
                      for name, df in (("baseline", before), ("clone", clone), ("baseline after", after))])


@register("scenario_stress", sql(_COUNTS_AS_DOUBLE, "mart_research_signals", ctes=oq.CTES_STRESS))
def _scenario_stress(spark, sf_dir):
    stressed = scenario.stress_scenario(G(spark, sf_dir), 0.6, -0.2)
    return _counts_as_double(stressed.get("mart_research_signals"))


@register("scenario_stress_script_factor", sql(_COUNTS_AS_DOUBLE, "mart_research_signals",
                                              ctes=oq.CTES_STRESS_SCRIPT))
def _scenario_stress_script(spark, sf_dir):
    """The script's variant of the stress (score * 0.4 - 0.2)."""
    stressed = scenario.stress_scenario(G(spark, sf_dir), 0.4, -0.2)
    return _counts_as_double(stressed.get("mart_research_signals"))


@register("scenario_compare", f"""
    SELECT a.ticker, a.composite_signal_score AS baseline, b.composite_signal_score AS stress_test,
           a.composite_signal_score - b.composite_signal_score AS delta
    FROM ({oq.model('mart_research_signals')}) a
    JOIN ({oq.model('mart_research_signals', ctes=oq.CTES_STRESS)}) b ON a.ticker = b.ticker""")
def _scenario_compare(spark, sf_dir):
    base = G(spark, sf_dir)
    stressed = scenario.stress_scenario(base, 0.6, -0.2)
    return scenario.scenario_compare(base.get("mart_research_signals"), stressed.get("mart_research_signals"))


# ======================================================================
# 2.7 change capture and refresh
# ======================================================================
_BEFORE, _AFTER = _BEFORE_SQL, _AFTER_SQL
_DIFFERS = " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in
                       ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
_CDC_SQL = f"""
    WITH b AS ({_BEFORE}), a AS ({_AFTER})
    SELECT a.*, 'INSERT' AS action, false AS is_update FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
    UNION ALL
    SELECT b.*, 'DELETE', false FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)
    UNION ALL
    SELECT b.*, 'DELETE', true FROM b JOIN a USING (o_orderkey) WHERE {_DIFFERS}
    UNION ALL
    SELECT a.*, 'INSERT', true FROM b JOIN a USING (o_orderkey) WHERE {_DIFFERS}"""


@register("cdc_changes", _CDC_SQL)
def _cdc_changes(spark, sf_dir):
    before, after = T(spark, sf_dir).cdc_pair()
    return cdc.cdc_changes(before, after, "o_orderkey")


@register("cdc_changes_fingerprint", _CDC_SQL)
def _cdc_changes_fingerprint(spark, sf_dir):
    """Wide-row variant: only (key, row fingerprint) is shuffled to classify."""
    before, after = T(spark, sf_dir).cdc_pair()
    return cdc.cdc_changes_fingerprint(before, after, "o_orderkey")


# Domain-table versions: "before" is the table as loaded before a cut-off
# date, "after" the whole table (the next day's load arrived).
_CUTS = {"raw_earnings_stream": ("earnings_calls", "call_id", "call_date", _dt.date(2024, 1, 20)),
         "raw_filings_stream": ("sec_filings", "filing_id", "filing_date", _dt.date(2024, 1, 20)),
         "raw_prices_stream": ("stock_prices", "price_id", "price_date", _dt.date(2024, 1, 29))}


def _versions(spark, sf_dir) -> dict[str, tuple[DataFrame, DataFrame, str]]:
    """Per stream: the version before, the one after, the key."""
    t = T(spark, sf_dir)
    out = {}
    for name, (table, key, dcol, cut) in _CUTS.items():
        full = getattr(t, table)
        out[name] = (full.filter(F.col(dcol) < F.lit(cut)), full, key)
    return {**out, "raw_orders_stream": (*t.cdc_pair(), "o_orderkey")}


def _streams(spark, sf_dir) -> dict[str, DataFrame]:
    """The changes of every stream; only buckets whose digests differ are joined."""
    return {name: cdc.cdc_changes_by_digest(*v) for name, v in _versions(spark, sf_dir).items()}


@register("cdc_changes_digest", _CDC_SQL)
def _cdc_changes_digest(spark, sf_dir):
    """Two stored versions: their digests say which partitions are read."""
    before, after = T(spark, sf_dir).cdc_pair()
    root = scratch_path(spark, "versions")
    for name, version in (("v1", before), ("v2", after)):
        cdc.store_version(version, f"{root}/{name}", "o_orderkey", buckets=16)
    return cdc.stored_changes(spark, f"{root}/v1", f"{root}/v2", "o_orderkey", after.schema)


@register("cdc_has_data", sql("\nUNION ALL\n".join(
    [f"SELECT '{n}' AS stream_name, EXISTS (SELECT 1 FROM {t} WHERE {d} >= DATE '{c.isoformat()}') AS has_data"
     for n, (t, k, d, c) in _CUTS.items()]
    + [f"SELECT 'raw_orders_stream', EXISTS (SELECT 1 FROM ({_CDC_SQL}) c)"]),
    "earnings_calls", "sec_filings", "stock_prices"))
def _cdc_has_data(spark, sf_dir):
    return cdc.has_data({name: v[:2] for name, v in _versions(spark, sf_dir).items()})


_UPSERT_SQL = f"""
    WITH t AS ({_BEFORE}), s AS (SELECT * FROM ({_CDC_SQL}) c WHERE action = 'INSERT')
    SELECT t.o_orderkey, t.o_custkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
           CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
           t.o_orderpriority
    FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
    UNION ALL
    SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderpriority
    FROM s WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM t)"""
_UPDATE_COLS = ("o_orderstatus", "o_totalprice")


@register("cdc_merge_upsert", _UPSERT_SQL)
def _cdc_merge_upsert(spark, sf_dir):
    """MERGE: matched keys update two columns, new keys insert all."""
    before, after = T(spark, sf_dir).cdc_pair()
    changes = cdc.cdc_changes(before, after, "o_orderkey")
    return cdc.upsert(before, changes, "o_orderkey", _UPDATE_COLS)


@register("cdc_stream_upsert", _UPSERT_SQL)
def _cdc_stream_upsert(spark, sf_dir):
    """Streaming form: two change drops processed by a file-source stream
    with availableNow into a table partitioned by a hash bucket of the key
    (only touched partitions are rewritten); the result equals the batch upsert."""
    before, after = T(spark, sf_dir).cdc_pair()
    changes = cdc.cdc_changes(before, after, "o_orderkey")
    root = scratch_path(spark, "cdc_stream")
    store = PartitionedTable(spark, f"{root}/target", key="o_orderkey", buckets=32)
    store.create(before)
    drops = [changes.filter(~F.col("is_update")), changes.filter(F.col("is_update"))]
    for i, drop in enumerate(drops):       # each drop arrives, then the stream catches up
        drop.write.parquet(f"{root}/src/drop{i + 1}")
        cdc_stream.run_cdc_stream(spark, f"{root}/src/*", drop.schema, store, "o_orderkey", _UPDATE_COLS, f"{root}/ckpt",
                                  trigger={"availableNow": True}, log_path=f"{root}/event_log",
                                  table_schema=before.schema).awaitTermination()
    return store.read(before.schema)


def _price_drops(spark, sf_dir) -> list[DataFrame]:
    bars = T(spark, sf_dir).stock_prices
    cut = F.lit(_dt.date(2024, 1, 20))
    return [bars.filter(F.col("price_date") < cut), bars.filter(F.col("price_date") >= cut)]


def _summary_of_bars(bars: DataFrame) -> DataFrame:
    return indicators.dt_price_summary(indicators.int_price_metrics(bars), NOW)


@register("dt_price_summary_stream", oq.model("dt_price_summary"))
def _dt_price_summary_stream(spark, sf_dir):
    """Keyed-state stream: each ticker's last 50 bars live in the state store;
    a micro-batch reads no old bars and rewrites the buckets of the tickers it brings."""
    root = scratch_path(spark, "dt_price_summary")
    for i, drop in enumerate(_price_drops(spark, sf_dir)):       # a new day of bars lands, the table refreshes
        drop.write.parquet(f"{root}/base/drop{i + 1}")
        bars = staging.stg_stock_prices(spark.readStream.schema(drop.schema).parquet(f"{root}/base/*"), AS_OF)
        refresh.last_bars_stream(spark, bars, _summary_of_bars, f"{root}/target", f"{root}/ckpt",
                                 trigger={"availableNow": True}).awaitTermination()
    return PartitionedTable(spark, f"{root}/target", key="ticker").read(G(spark, sf_dir).get("dt_price_summary").schema)


@register("dt_price_summary_refresh", oq.model("dt_price_summary"))
def _dt_price_summary_refresh(spark, sf_dir):
    """Refresh stream: per micro-batch, recompute only the affected tickers from the base."""
    root = scratch_path(spark, "dt_price_refresh")
    for i, drop in enumerate(_price_drops(spark, sf_dir)):
        drop.write.parquet(f"{root}/base/drop{i + 1}")
        refresh.refresh_stream(spark, lambda raw: indicators.dt_price_summary_from_bars(staging.stg_stock_prices(raw, AS_OF), NOW),
                               f"{root}/base/*", drop.schema, f"{root}/target", ["ticker"], f"{root}/ckpt",
                               trigger={"availableNow": True}, buckets=64).awaitTermination()
    return PartitionedTable(spark, f"{root}/target", key="ticker").read(G(spark, sf_dir).get("dt_price_summary").schema)


@register("dt_filing_risk_signals_stream", oq.model("dt_filing_risk_signals"))
def _dt_filing_risk_signals_stream(spark, sf_dir):
    """Refresh stream into a table partitioned by filing day: new filings
    recompute and rewrite only their own days."""
    from tidemark.plans.graph import dt_filing_risk_signals
    filings = T(spark, sf_dir).sec_filings
    root = scratch_path(spark, "dt_filing_risk")

    def body(raw):
        stg = staging.stg_sec_filings(raw, AS_OF)
        return dt_filing_risk_signals(enrich.int_filing_classifications(stg, FIXTURE), NOW)

    cut = F.lit(_dt.date(2024, 1, 10))
    drops = [filings.filter(F.col("filing_date") < cut), filings.filter(F.col("filing_date") >= cut)]
    for i, drop in enumerate(drops):
        drop.write.parquet(f"{root}/base/drop{i + 1}")
        refresh.refresh_stream(spark, body, f"{root}/base/*", filings.schema, f"{root}/target",
                               ["filing_date"], f"{root}/ckpt", trigger={"availableNow": True},
                               by_partition=True).awaitTermination()
    return PartitionedTable(spark, f"{root}/target", ["filing_date"]).read(G(spark, sf_dir).get("dt_filing_risk_signals").schema)


@register("dt_earnings_sentiment_stream", oq.model("dt_earnings_sentiment"))
def _dt_earnings_sentiment_stream(spark, sf_dir):
    """Row-wise refreshed table as a stateless append stream."""
    from tidemark.plans.graph import dt_earnings_sentiment
    calls = T(spark, sf_dir).earnings_calls
    root = scratch_path(spark, "dt_earnings_sentiment")
    calls.write.parquet(f"{root}/base")
    schema = spark.read.parquet(f"{root}/base").schema
    body = lambda df: dt_earnings_sentiment(staging.stg_earnings_calls(df, AS_OF), NOW, FIXTURE)
    q = refresh.append_stream(spark, body, f"{root}/base", schema, f"{root}/target", f"{root}/ckpt",
                              trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{root}/target")


# The reference suites with bounds that fit the driver tables (their tickers,
# filings and prices are made up): what may differ between deployments. A
# ticker is "U" and a user id of any length; a price is an event's value, 0 included.
_LOOSE = {("regex", "ticker"): {"pattern": "^U[0-9]+$"}, ("row_count", None): {"lo": 0, "hi": 10 ** 15},
          ("length_between", "transcript_text"): {"lo": 0, "hi": 10 ** 9}, ("length_between", "section_text"): {"lo": 0, "hi": 10 ** 9},
          **{("between", c): {"lo": 0.0} for c in ("open_price", "high_price", "low_price", "close_price")}}
DRIVER_SUITES = {t: [replace(c, **_LOOSE.get((c.kind, c.column), {})) for c in suite] for t, suite in quality.SUITES.items()}


@register("refresh_group", sql(_COUNTS_AS_DOUBLE, "mart_research_signals"))
def _refresh_group(spark, sf_dir):
    """The 'prices' group (staging -> research signals) behind its gate,
    materialized in dependency order; the mart is read back from its table."""
    built = run_pipeline(G(spark, sf_dir), "prices", scratch_path(spark, "refresh_prices"), gate=DRIVER_SUITES)
    return _counts_as_double(built["mart_research_signals"])


@register("refresh_group_earnings", oq.model("mart_earnings_summary"))
def _refresh_group_earnings(spark, sf_dir):
    built = run_pipeline(G(spark, sf_dir), "earnings", scratch_path(spark, "refresh_earnings"), gate=DRIVER_SUITES)
    return built["mart_earnings_summary"]


@register("refresh_group_filings", oq.model("mart_filing_dashboard"))
def _refresh_group_filings(spark, sf_dir):
    built = run_pipeline(G(spark, sf_dir), "filings", scratch_path(spark, "refresh_filings"), gate=DRIVER_SUITES)
    return built["mart_filing_dashboard"]


@register("refresh_group_ml", oq.model("ml_sentiment_training"))
def _refresh_group_ml(spark, sf_dir):
    """The weekly ML group: filing embeddings and the training table."""
    built = run_pipeline(G(spark, sf_dir), "ml", scratch_path(spark, "refresh_ml"), gate=DRIVER_SUITES)
    return built["ml_sentiment_training"]


# ======================================================================
# 2.1 sources, sinks, layouts
# ======================================================================
@register("src_csv_load", oq.model("earnings_calls"))
def _src_csv_load(spark, sf_dir):
    path = scratch_path(spark, "csv_earnings")
    files.write_csv(T(spark, sf_dir).earnings_calls, path)
    return files.load_csv(spark, path, schemas.EARNINGS_CALLS, multiLine="true")     # transcripts span lines


_DEFAULTED = [("earnings_calls", "call_id", schemas.EARNINGS_DEFAULTS), ("sec_filings", "filing_id", schemas.FILINGS_DEFAULTS),
              ("stock_prices", "price_id", schemas.PRICES_DEFAULTS)]
# rows whose load time is missing before the defaults are filled in
_UNLOADED = "substr(md5({id}), 1, 1) < '8'"


@register("ingest_defaults", sql("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, {i} AS id, "
    + ("coalesce(confidence_score, CAST(0.85 AS DOUBLE))" if t == "earnings_calls" else "CAST(NULL AS DOUBLE)")
    + f" AS confidence_score, CASE WHEN {_UNLOADED.format(id=i)} THEN 'now' ELSE strftime(_loaded_at, '%Y-%m-%d %H:%M:%S') END AS loaded_at, "
    "'timestamp_ntz' AS loaded_type FROM " + t for t, i, _ in _DEFAULTED), *[t for t, _, _ in _DEFAULTED]))
def _ingest_defaults(spark, sf_dir):
    """Defaults of all three raw tables: half the rows arrive without a load
    time; the default keeps the declared type."""
    parts = []
    for name, key, defaults in _DEFAULTED:
        raw = _raw_tables(spark, sf_dir)[name].withColumn(
            "_loaded_at", F.when(~F.expr(_UNLOADED.format(id=key)), F.col("_loaded_at")))
        df = files.with_defaults(raw, defaults)
        score = F.col("confidence_score") if "confidence_score" in df.columns else F.lit(None).cast("double")
        now = F.col("_loaded_at") >= F.date_sub(F.current_date(), 1).cast("timestamp_ntz")
        parts.append(df.select(F.lit(name).alias("table_name"), F.col(key).alias("id"), score.alias("confidence_score"),
                               F.when(now, "now").otherwise(F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss")).alias("loaded_at"),
                               F.lit(df.schema["_loaded_at"].dataType.simpleString()).alias("loaded_type")))
    return union_all(parts)


@register("sink_insert_select", oq.model("stock_prices"))
def _sink_insert_select(spark, sf_dir):
    bars = T(spark, sf_dir).stock_prices
    target = scratch_path(spark, "insert_select")
    cut = F.lit(_dt.date(2024, 1, 15))
    sinks.append(bars.filter(F.col("price_date") < cut), target)
    sinks.append(bars.filter(F.col("price_date") >= cut), target)
    return spark.read.parquet(target)


@register("sink_materialize", oq.model("int_filing_classifications"))
def _sink_materialize(spark, sf_dir):
    df = G(spark, sf_dir).get("int_filing_classifications")
    return sinks.materialize(df, "int_filing_classifications", "table", "staging",
                             scratch_path(spark, "materialize"))


@register("layout_cluster", oq.model("stock_prices"))
def _layout_cluster(spark, sf_dir):
    target = scratch_path(spark, "clustered_prices")
    sinks.write_clustered(T(spark, sf_dir).stock_prices, target, ["ticker", "price_date"])
    return spark.read.parquet(target)


@register("layout_point_lookup", oq.model("sec_filings"))
def _layout_point_lookup(spark, sf_dir):
    target = scratch_path(spark, "bloom_filings")
    sinks.write_with_bloom(T(spark, sf_dir).sec_filings, target, ["ticker", "filing_type", "item_type"])
    return spark.read.parquet(target)


_LOOKUP_SQL = ("SELECT {cols} FROM {table} t WHERE {col} IN (SELECT {col} FROM (SELECT {col}, count(*) AS n FROM {table} "
               "WHERE {col} IS NOT NULL GROUP BY {col}) ORDER BY n, {col} LIMIT 3)")


def _rarest(df: DataFrame, col: str) -> DataFrame:
    """A small key table: the three rarest values."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy("n", col).limit(3).select(col))


@register("layout_point_lookup_rows", sql("\nUNION ALL\n".join([
    "SELECT 'ticker' AS looked_up, filing_id AS id FROM (" + _LOOKUP_SQL.format(cols="filing_id", table="sec_filings", col="ticker") + ")",
    "SELECT 'speaker_role', call_id FROM (" + _LOOKUP_SQL.format(cols="call_id", table="earnings_calls", col="speaker_role") + ")"]),
    "sec_filings", "earnings_calls"))
def _layout_point_lookup_rows(spark, sf_dir):
    """Rows of the keys of a key table, from sorted, bloom-filtered files."""
    t, out = T(spark, sf_dir), []
    for table, cols, key in ((t.sec_filings, ["ticker", "filing_type", "item_type"], "filing_id"), (t.earnings_calls, ["speaker_role", "ticker"], "call_id")):
        target = scratch_path(spark, "bloom")
        sinks.write_with_bloom(table, target, cols)
        found = sinks.lookup(spark, target, cols[0], _rarest(table, cols[0]), table.schema)
        out.append(found.select(F.lit(cols[0]).alias("looked_up"), F.col(key).alias("id")))
    return union_all(out)


@register("sink_event_log", None)
def _sink_event_log(spark, sf_dir):
    """Audit rows for every change action of the orders stream, appended to
    the event log (uuid id, event time, VARIANT details) and read back."""
    before, after = T(spark, sf_dir).cdc_pair()
    counts = (cdc.cdc_changes(before, after, "o_orderkey").groupBy("action", "is_update")
              .agg(F.count(F.lit(1)).alias("n")))
    target = scratch_path(spark, "event_log")
    rows = sinks.event_rows(counts, F.concat(F.lit("CDC_"), F.col("action")),
                            F.to_json(F.struct("action", "is_update")), F.col("n"))
    sinks.append_events(rows, target)
    return sinks.read_event_log(spark, target).select(
        "event_id", "event_type", "event_time", F.to_json("details").alias("details"), "records_affected")


@register("sink_event_log_content", f"""
    SELECT 'CDC_' || action AS event_type,
           to_json({{'action': action, 'is_update': is_update}}) AS details,
           count(*) AS records_affected
    FROM ({_CDC_SQL}) c GROUP BY action, is_update""")
def _sink_event_log_content(spark, sf_dir):
    """The event-log sink read back, deterministic columns only (the id is a
    random UUID and the time the load time): type, VARIANT details as JSON,
    row count."""
    before, after = T(spark, sf_dir).cdc_pair()
    counts = (cdc.cdc_changes(before, after, "o_orderkey").groupBy("action", "is_update")
              .agg(F.count(F.lit(1)).alias("n")))
    target = scratch_path(spark, "event_log_content")
    sinks.append_events(sinks.event_rows(counts, F.concat(F.lit("CDC_"), F.col("action")),
                                  F.to_json(F.struct("action", "is_update")), F.col("n")), target)
    return sinks.read_event_log(spark, target).select(
        "event_type", F.to_json("details").alias("details"), "records_affected")


# ======================================================================
# 2.8 governance
# ======================================================================
# Policy ticker lists for the driver tables (fixture: the reference's lists
# name tickers that do not occur there).
FIXTURE_ROLE_TICKERS = {gov.SECTOR_TECH: ("U0", "U2", "U4", "U6", "U8"), gov.SECTOR_ENERGY: ("U10",)}


def _roles_sql(select_for_role: Callable[[str], str]) -> str:
    return "\nUNION ALL\n".join(select_for_role(r) for r in gov.ROLES)


def _mask_transcript_sql(role: str) -> str:
    t = "transcript_text"
    if role in gov.FULL_TEXT_ROLES:
        v = t
    elif role in gov.SECTOR_ROLES:
        v = f"left({t}, 200) || '... [REDACTED - ' || CAST(length({t}) AS VARCHAR) || ' total characters]'"
    else:
        v = f"left({t}, 100) || '... [REDACTED - Contact administrator for full access]'"
    return f"SELECT call_id, '{role}' AS role, {v} AS transcript_text FROM stg_earnings_calls"


def _per_role(df: DataFrame) -> DataFrame:
    """Every row once per role, from one scan; masks read the role per row."""
    return df.withColumn("role", F.explode(F.array(*[F.lit(r) for r in gov.ROLES])))


@register("mask_transcript", sql(_roles_sql(_mask_transcript_sql), "stg_earnings_calls"))
def _mask_transcript(spark, sf_dir):
    df = _stg_calls(spark, sf_dir)
    return _per_role(df).select("call_id", "role", gov.mask_transcript(F.col("transcript_text"), F.col("role")).alias("transcript_text"))


def _bucket_sql(v: str) -> str:
    return (f"CAST(CASE WHEN {v} > 0.5 THEN 0.75 WHEN {v} > 0.0 THEN 0.25 WHEN {v} > -0.5 THEN -0.25 "
            f"ELSE -0.75 END AS DOUBLE)")


@register("mask_sentiment_range", sql(_roles_sql(lambda r: (
    f"SELECT ticker, call_date, company_name, '{r}' AS role, "
    f"{'sentiment_score' if r in gov.EXACT_SCORE_ROLES else _bucket_sql('sentiment_score')} AS sentiment_score "
    f"FROM mart_earnings_summary")), "mart_earnings_summary"))
def _mask_sentiment_range(spark, sf_dir):
    df = G(spark, sf_dir).get("mart_earnings_summary")
    return _per_role(df).select("ticker", "call_date", "company_name", "role",
                                gov.mask_sentiment(F.col("sentiment_score"), F.col("role")).alias("sentiment_score"))


@register("mask_embedding", sql(_roles_sql(lambda r: (
    f"SELECT filing_id, '{r}' AS role, " + ", ".join(
        (f"emb_{i}" if r in gov.VECTOR_ROLES else "CAST(0.0 AS DOUBLE)") + f" AS emb_{i}" for i in range(1, 6))
    + " FROM ml_filing_embeddings")), "ml_filing_embeddings"))
def _mask_embedding(spark, sf_dir):
    df = G(spark, sf_dir).get("ml_filing_embeddings")
    m = gov.mask_embedding(F.col("embedding_vector"), F.col("role"))
    return _per_role(df).select("filing_id", "role", *[m[i].alias(f"emb_{i + 1}") for i in range(5)])


@register("mask_file_size", sql(_roles_sql(lambda r: (
    f"SELECT filing_id, '{r}' AS role, "
    + ("file_size_kb" if r == gov.ADMIN else
       f"CAST({hu('CAST(file_size_kb AS DOUBLE) / 10.0', 0)} * 10.0 AS BIGINT)")
    + " AS file_size_kb FROM stg_sec_filings")), "stg_sec_filings"))
def _mask_file_size(spark, sf_dir):
    df = _stg_filings(spark, sf_dir)
    return _per_role(df).select("filing_id", "role", gov.mask_file_size(F.col("file_size_kb"), F.col("role")).alias("file_size_kb"))


def _row_access_sql(r: str, cols: str = "ticker", table: str = "mart_research_signals") -> str:
    if r in gov.ALL_ROWS_ROLES:
        cond = "true"
    elif r in FIXTURE_ROLE_TICKERS:
        cond = "ticker IN (" + ", ".join(f"'{t}'" for t in FIXTURE_ROLE_TICKERS[r]) + ")"
    else:
        cond = "false"
    return f"SELECT '{r}' AS role, {cols} FROM {table} WHERE {cond}"


@register("row_access_ticker", sql(_roles_sql(_row_access_sql), "mart_research_signals"))
def _row_access_ticker(spark, sf_dir):
    """The mart derived once, its rows given out for each role that may see them."""
    rt = gov.role_tickers_frame(spark, FIXTURE_ROLE_TICKERS)
    return gov.per_role(G(spark, sf_dir).get("mart_research_signals"), role_tickers=rt, col="ticker").select("role", "ticker")


_SV_COLS = ("ticker, close_price, ma_20d, ma_50d, volatility_pct, sharpe_ratio, {ceo} AS ceo_sentiment, "
            "CAST(total_risk_flags AS DOUBLE) AS total_risk_flags, CAST(high_risk_count AS DOUBLE) "
            "AS high_risk_count, composite_signal_score, signal_direction, signal_generated_at")


@register("secure_view", sql(_roles_sql(lambda r: _row_access_sql(
    r, _SV_COLS.format(ceo="ceo_sentiment" if r in gov.EXACT_SCORE_ROLES else _bucket_sql("ceo_sentiment")))),
    "mart_research_signals"))
def _secure_view(spark, sf_dir):
    """All policies attached to the research-signals mart, for every role, from one derivation."""
    rt = gov.role_tickers_frame(spark, FIXTURE_ROLE_TICKERS)
    return _counts_as_double(gov.secure_view_roles(G(spark, sf_dir).get("mart_research_signals"), "mart_research_signals", role_tickers=rt))


# every attached table: what a role sees of it, as numbers that tell a masked value from a plain one
_TOLD = {"stg_earnings_calls": "transcript_text", "int_earnings_sentiment": "transcript_text", "mart_earnings_summary": "sentiment_score",
         "mart_research_signals": "ceo_sentiment", "ml_filing_embeddings": "embedding_vector"}


def _told_sql(table: str) -> str:
    col = _TOLD.get(table)
    if col is None:
        return "0.0"
    if col == "transcript_text":
        return "CAST(sum(length(transcript_text)) AS DOUBLE)"
    if col == "embedding_vector":
        return hu("sum(abs(emb_1) + abs(emb_2) + abs(emb_3) + abs(emb_4) + abs(emb_5))", 4)
    return hu(f"sum({col})", 4)


def _attached_sql(table: str, role: str) -> str:
    row_col, masks = gov.ATTACHED[table]
    src = table
    if "transcript_text" in masks:
        src = (f"(SELECT * REPLACE ({_mask_transcript_sql(role).split(' AS role, ')[1].split(' AS transcript_text')[0]} AS transcript_text) FROM {table})")
    elif "embedding_vector" in masks and role not in gov.VECTOR_ROLES:
        src = f"(SELECT 0.0 AS emb_1, 0.0 AS emb_2, 0.0 AS emb_3, 0.0 AS emb_4, 0.0 AS emb_5 FROM {table})"
    elif masks and "embedding_vector" not in masks and role not in gov.EXACT_SCORE_ROLES:
        src = f"(SELECT * REPLACE ({_bucket_sql(_TOLD[table])} AS {_TOLD[table]}) FROM {table})"
    seen = _row_access_sql(role, "1").split(" WHERE ")[1] if row_col else "true"
    return f"SELECT '{table}' AS table_name, '{role}' AS role, count(*) AS visible_rows, coalesce({_told_sql(table)}, 0.0) AS told FROM {src} t WHERE {seen}"


def _told(table: str):
    col = _TOLD.get(table)
    if col is None:
        return F.lit(0.0)
    if col == "transcript_text":
        return F.sum(F.length(col)).cast("double")
    if col == "embedding_vector":
        return half_up(F.sum(F.aggregate(F.slice(col, 1, 5), F.lit(0.0), lambda a, x: a + F.abs(x))), 4)
    return half_up(F.sum(col), 4)


@register("secure_view_all", sql("\nUNION ALL\n".join(_attached_sql(t, r) for t in gov.ATTACHED for r in gov.ROLES), *gov.ATTACHED))
def _secure_view_all(spark, sf_dir):
    """Policies of all attached tables: rows and content that each role sees, each table derived once."""
    g, rt = G(spark, sf_dir), gov.role_tickers_frame(spark, FIXTURE_ROLE_TICKERS)
    roles = spark.createDataFrame([(r,) for r in gov.ROLES], "role string")
    parts = []
    for table in gov.ATTACHED:
        seen = gov.secure_view_roles(g.get(table), table, role_tickers=rt).groupBy("role").agg(
            F.count(F.lit(1)).alias("visible_rows"), F.coalesce(_told(table), F.lit(0.0)).alias("told"))
        parts.append(roles.join(seen, "role", "left").select(F.lit(table).alias("table_name"), "role", F.coalesce("visible_rows", F.lit(0)).alias("visible_rows"),
                                                             F.coalesce("told", F.lit(0.0)).alias("told")))
    return union_all(parts)


@register("secure_view_sql", sql("\nUNION ALL\n".join(_attached_sql(t, r) for t in gov.ATTACHED for r in gov.ROLES), *gov.ATTACHED))
def _secure_view_sql(spark, sf_dir):
    """The same by plain SQL: functions, a session variable for the role, views on them."""
    g = G(spark, sf_dir)
    policies_sql.install(spark, gov.role_tickers_frame(spark, FIXTURE_ROLE_TICKERS))
    tables = {t: g.get(t) for t in gov.ATTACHED}
    policies_sql.create_views(spark, {t: df.withColumn("embedding_vector", F.col("embedding_vector").cast("array<double>"))
                                      if t == "ml_filing_embeddings" else df for t, df in tables.items()})
    parts = []
    for role in gov.ROLES:
        policies_sql.set_role(spark, role)
        parts += [spark.sql(f"SELECT * FROM secure_{t}").agg(F.count(F.lit(1)).alias("visible_rows"), F.coalesce(_told(t), F.lit(0.0)).alias("told"))
                  .select(F.lit(t).alias("table_name"), F.lit(role).alias("role"), "visible_rows", "told") for t in gov.ATTACHED]
    return union_all(parts)


# ======================================================================
# 2.9 monitoring
# ======================================================================
CHECK_TIME = _dt.datetime(2024, 2, 1, 18, 0, 0)   # monitors evaluated 30 h after the marts
SQL_CHECK_TIME = "TIMESTAMP '2024-02-01 18:00:00'"


def _fresh_tables(t):
    return {"earnings_calls": (t.earnings_calls, "call_date"), "sec_filings": (t.sec_filings, "filing_date"),
            "stock_prices": (t.stock_prices, "price_date")}


_FRESH_SQL = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS source, max({c}) AS latest_date, "
    f"date_diff('hour', CAST(max({c}) AS TIMESTAMP), {SQL_NOW}) AS hours_since_latest, "
    f"count(*) AS total_records FROM {n}"
    for n, c in [("earnings_calls", "call_date"), ("sec_filings", "filing_date"), ("stock_prices", "price_date")])


@register("mon_freshness", sql(_FRESH_SQL, "earnings_calls", "sec_filings", "stock_prices"))
def _mon_freshness(spark, sf_dir):
    return monitor.freshness(_fresh_tables(T(spark, sf_dir)), NOW)


def _trend_sql(table: str, dcol: str) -> str:
    w = f"OVER (ORDER BY {dcol} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    return (f"SELECT {dcol}, count(*) AS daily_count, avg(count(*)) {w} AS rolling_7d_avg, "
            f"count(*) / NULLIF(avg(count(*)) {w}, 0) AS volume_ratio FROM {table} "
            f"WHERE {dcol} >= {SQL_AS_OF} - 30 GROUP BY {dcol}")


@register("mon_volume_trend", sql(_trend_sql("earnings_calls", "call_date"), "earnings_calls"))
def _mon_volume_trend(spark, sf_dir):
    return monitor.volume_trend(T(spark, sf_dir).earnings_calls, "call_date", AS_OF)


@register("mon_volume_trend_filings", sql(_trend_sql("sec_filings", "filing_date"), "sec_filings"))
def _mon_volume_trend_filings(spark, sf_dir):
    return monitor.volume_trend(T(spark, sf_dir).sec_filings, "filing_date", AS_OF)


@register("mon_volume_drop", sql(
    f"SELECT call_date, daily_count, rolling_7d_avg, {hu('volume_ratio * 100.0', 1)} AS volume_pct_of_avg "
    f"FROM ({_trend_sql('earnings_calls', 'call_date')}) t WHERE volume_ratio < 0.5", "earnings_calls"))
def _mon_volume_drop(spark, sf_dir):
    trend = monitor.volume_trend(T(spark, sf_dir).earnings_calls, "call_date", AS_OF)
    return monitor.volume_drop(trend, "call_date")


# The orders as a feed whose last day is near the present: its days differ much in volume.
_ORDER_SHIFT = 8218
_ORDER_FEED_SQL = f"(SELECT *, CAST(o_orderdate AS DATE) + {_ORDER_SHIFT} AS call_date FROM orders) d"


def _order_feed(spark, sf_dir) -> DataFrame:
    orders = T(spark, sf_dir).raw("orders")
    return orders.withColumn("call_date", F.date_add(F.col("o_orderdate").cast("date"), _ORDER_SHIFT))


@register("mon_volume_drop_dip", sql(
    f"SELECT call_date, daily_count, rolling_7d_avg, {hu('volume_ratio * 100.0', 1)} AS volume_pct_of_avg "
    f"FROM ({_trend_sql(_ORDER_FEED_SQL, 'call_date')}) t WHERE volume_ratio < 0.5"))
def _mon_volume_drop_dip(spark, sf_dir):
    """The same monitor over a feed with dipping days."""
    return monitor.volume_drop(monitor.volume_trend(_order_feed(spark, sf_dir), "call_date", AS_OF), "call_date")


# Nullability is what Spark reports for the adapter output (fixed values).
_EC_SCHEMA = [("call_id", "string", True), ("ticker", "string", True), ("company_name", "string", True),
              ("call_date", "date", True), ("call_type", "string", False), ("quarter", "int", False),
              ("fiscal_year", "int", False), ("speaker_name", "string", True),
              ("speaker_role", "string", False), ("transcript_text", "string", True),
              ("confidence_score", "double", True), ("_loaded_at", "timestamp_ntz", True)]


@register("mon_schema_snapshot", sql("\nUNION ALL\n".join(
    f"SELECT 'earnings_calls' AS table_name, '{c}' AS column_name, '{t}' AS data_type, {str(n).lower()} "
    f"AS is_nullable, count({c}) AS non_null_count, count(*) - count({c}) AS null_count FROM earnings_calls"
    for c, t, n in _EC_SCHEMA), "earnings_calls"))
def _mon_schema_snapshot(spark, sf_dir):
    return monitor.schema_snapshot(T(spark, sf_dir).earnings_calls, "earnings_calls")


@register("mon_schema_unexpected", sql("""
    SELECT 'sentiment_score' AS column_name, 'double' AS data_type, count(sentiment_score) AS non_null_count
    FROM int_earnings_sentiment
    UNION ALL SELECT 'ai_summary', 'string', count(ai_summary) FROM int_earnings_sentiment""", "int_earnings_sentiment"))
def _mon_schema_unexpected(spark, sf_dir):
    """The enriched call table against the raw column list."""
    return monitor.schema_unexpected(G(spark, sf_dir).get("int_earnings_sentiment"),
                                     schemas.EARNINGS_CALLS_EXPECTED_COLUMNS)


@register("mon_score_distribution", sql(f"""
    SELECT count(*) AS total_records, {hu('avg(sentiment_score)', 4)} AS mean_sentiment,
           {hu('stddev_samp(sentiment_score)', 4)} AS std_sentiment,
           min(sentiment_score) AS min_sentiment, max(sentiment_score) AS max_sentiment,
           count(*) FILTER (WHERE sentiment_score IS NULL) AS null_count,
           {hu('CAST(count(*) FILTER (WHERE sentiment_score IS NULL) AS DOUBLE) * 100.0 / count(*)', 2)}
             AS null_pct
    FROM int_earnings_sentiment""", "int_earnings_sentiment"))
def _mon_score_distribution(spark, sf_dir):
    return monitor.score_distribution(G(spark, sf_dir).get("int_earnings_sentiment"), "sentiment_score")


@register("mon_score_outliers", sql(f"""
    SELECT e.call_id, e.ticker, e.call_date, e.sentiment_score,
           {hu('abs(e.sentiment_score - s.m) / NULLIF(s.sd, 0)', 2)} AS z_score
    FROM int_earnings_sentiment e,
         (SELECT avg(sentiment_score) AS m, stddev_samp(sentiment_score) AS sd FROM int_earnings_sentiment) s
    WHERE abs(e.sentiment_score - s.m) / NULLIF(s.sd, 0) > 3""",
    "int_earnings_sentiment"))
def _mon_score_outliers(spark, sf_dir):
    return monitor.score_outliers(G(spark, sf_dir).get("int_earnings_sentiment"), "sentiment_score")


def _share_sql(col: str, table: str, cnt: str) -> str:
    return (f"SELECT {col}, count(*) AS {cnt}, "
            f"{hu('CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE)', 2)} "
            f"AS pct_of_total FROM {table} GROUP BY {col}")


@register("mon_category_distribution", sql(_share_sql("risk_category", "int_filing_classifications",
                                                      "record_count"), "int_filing_classifications"))
def _mon_category_distribution(spark, sf_dir):
    return monitor.category_distribution(G(spark, sf_dir).get("int_filing_classifications"))


_FLAG = "count(*) FILTER (WHERE risk_category != 'OPERATIONAL')"


@register("mon_risk_surge", sql(f"""
    SELECT filing_date, count(*) AS total_filings, {_FLAG} AS risk_flagged,
           {hu(f'CAST({_FLAG} AS DOUBLE) * 100.0 / count(*)', 1)} AS risk_pct
    FROM int_filing_classifications WHERE filing_date >= {SQL_AS_OF} - 7
    GROUP BY filing_date HAVING CAST({_FLAG} AS DOUBLE) * 100.0 / count(*) > 60""",
    "int_filing_classifications"))
def _mon_risk_surge(spark, sf_dir):
    return monitor.risk_surge(G(spark, sf_dir).get("int_filing_classifications"), AS_OF)


@register("mon_embedding_dims", sql("""
    SELECT count(*) AS total_embeddings,
           count(*) FILTER (WHERE len([emb_1, emb_2, emb_3, emb_4, emb_5]) != 5) AS wrong_dimension_count,
           0::BIGINT AS null_embedding_count FROM ml_filing_embeddings""", "ml_filing_embeddings"))
def _mon_embedding_dims(spark, sf_dir):
    return monitor.embedding_dims(G(spark, sf_dir).get("ml_filing_embeddings"), "embedding_vector", 5)


@register("mon_embedding_drift", """
    SELECT CAST(len(embedding) AS BIGINT) AS dimension, count(*) AS count FROM embeddings GROUP BY 1""")
def _mon_embedding_drift(spark, sf_dir):
    return monitor.embedding_drift(T(spark, sf_dir).vectors, "embedding")


@register("mon_signal_distribution", sql(f"""
    SELECT signal_direction, count(*) AS ticker_count,
           {hu('avg(composite_signal_score)', 2)} AS avg_composite_score,
           min(composite_signal_score) AS min_score, max(composite_signal_score) AS max_score
    FROM mart_research_signals GROUP BY signal_direction""", "mart_research_signals"))
def _mon_signal_distribution(spark, sf_dir):
    return monitor.signal_distribution(G(spark, sf_dir).get("mart_research_signals"))


@register("mon_stale_signals", sql(f"""
    SELECT ticker, signal_generated_at, date_diff('hour', signal_generated_at, {SQL_CHECK_TIME}) AS hours_stale
    FROM mart_research_signals WHERE date_diff('hour', signal_generated_at, {SQL_CHECK_TIME}) > 24""",
    "mart_research_signals"))
def _mon_stale_signals(spark, sf_dir):
    return monitor.stale_signals(G(spark, sf_dir).get("mart_research_signals"),
                                 CHECK_TIME)


@register("mon_accuracy_distribution", sql(_share_sql("prediction_accuracy", "mart_earnings_summary",
                                                      "occurrence_count"), "mart_earnings_summary"))
def _mon_accuracy_distribution(spark, sf_dir):
    return monitor.accuracy_distribution(G(spark, sf_dir).get("mart_earnings_summary"))


_CONTRARY = "count(*) FILTER (WHERE prediction_accuracy = 'Contrary Signal')"


@register("mon_accuracy_degradation", sql(f"""
    SELECT fiscal_year, quarter, count(*) AS total_predictions, {_CONTRARY} AS contrary_count,
           {hu(f'CAST({_CONTRARY} AS DOUBLE) * 100.0 / count(*)', 1)} AS contrary_pct
    FROM mart_earnings_summary GROUP BY 1, 2
    HAVING CAST({_CONTRARY} AS DOUBLE) * 100.0 / count(*) > 30""", "mart_earnings_summary"))
def _mon_accuracy_degradation(spark, sf_dir):
    return monitor.accuracy_degradation(G(spark, sf_dir).get("mart_earnings_summary"))


# Refresh lag targets for the run-log fixture names (fixed values).
RUN_LAGS = {"view": "1 minute", "click": "5 minutes", "purchase": "10 minutes"}
_RUNLOG = """SELECT event_type AS name, ts AS completed_time,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
       CASE WHEN event_type = 'error' THEN 'E' || CAST(event_id AS VARCHAR) END AS error_code FROM events"""
_LAGS_SQL = " UNION ALL ".join(f"SELECT '{k}' AS table_name, '{v}' AS target_lag" for k, v in RUN_LAGS.items())
_HEALTH_SQL = f"""
    WITH log AS ({_RUNLOG}), lags AS ({_LAGS_SQL}),
    latest AS (SELECT name AS table_name, arg_max(state, completed_time) AS state,
                      max(completed_time) AS last_refresh_time FROM log GROUP BY name)"""


@register("mon_refresh_health", f"""{_HEALTH_SQL}
    SELECT l.table_name, l.state, g.target_lag, l.last_refresh_time,
           date_diff('second', l.last_refresh_time, {SQL_NOW}) AS seconds_since_last_refresh,
           date_diff('minute', l.last_refresh_time, {SQL_NOW}) AS minutes_since_refresh
    FROM latest l LEFT JOIN lags g USING (table_name)""")
def _mon_refresh_health(spark, sf_dir):
    return monitor.refresh_health(T(spark, sf_dir).run_log, NOW, RUN_LAGS)


@register("mon_refresh_stuck", f"""{_HEALTH_SQL}
    SELECT table_name, state, date_diff('hour', last_refresh_time, {SQL_NOW}) AS hours_since_refresh
    FROM latest WHERE state != 'FRONTEND_REFRESHING' AND date_diff('hour', last_refresh_time, {SQL_NOW}) > 6""")
def _mon_refresh_stuck(spark, sf_dir):
    return monitor.refresh_stuck(T(spark, sf_dir).run_log, NOW)


# Stream registry (fixed values): the four change streams.
STREAMS = [("raw_earnings_stream", "EARNINGS_CALLS"), ("raw_filings_stream", "SEC_FILINGS"),
           ("raw_prices_stream", "STOCK_PRICES"), ("raw_orders_stream", "ORDERS")]
STREAM_CREATED = _dt.datetime(2024, 1, 1)


def _registry(spark):
    return spark.createDataFrame([(n, t) for n, t in STREAMS], "stream_name string, source_table string") \
        .withColumn("stream_created", ts_lit(STREAM_CREATED))


def _stream_counts_sql() -> str:
    parts = []
    for n, (table, key, dcol, cut) in _CUTS.items():
        parts.append(f"SELECT '{n}' AS stream_name, count(*) AS total_inserts, 0::BIGINT AS total_updates, "
                     f"0::BIGINT AS total_deletes, CAST(max(_loaded_at) AS TIMESTAMP) AS last_activity "
                     f"FROM {table} WHERE {dcol} >= DATE '{cut.isoformat()}'")
    parts.append(f"""SELECT 'raw_orders_stream', count(*) FILTER (WHERE action = 'INSERT' AND NOT is_update),
        count(*) FILTER (WHERE action = 'INSERT' AND is_update), count(*) FILTER (WHERE action = 'DELETE'
        AND NOT is_update), CAST(NULL AS TIMESTAMP) FROM ({_CDC_SQL}) c""")
    return "\nUNION ALL\n".join(parts)


_REG_SQL = " UNION ALL ".join(f"SELECT '{n}' AS stream_name, '{t}' AS source_table, "
                              f"TIMESTAMP '2024-01-01 00:00:00' AS stream_created" for n, t in STREAMS)


@register("mon_cdc_throughput", sql(f"""
    SELECT r.stream_name, r.source_table, r.stream_created, c.total_inserts, c.total_updates,
           c.total_deletes, c.last_activity
    FROM ({_REG_SQL}) r LEFT JOIN ({_stream_counts_sql()}) c USING (stream_name)""",
    "earnings_calls", "sec_filings", "stock_prices"))
def _mon_cdc_throughput(spark, sf_dir):
    counts = cdc.change_counts(_streams(spark, sf_dir), time_col="_loaded_at")
    return monitor.cdc_throughput(_registry(spark), counts)


@register("mon_cdc_inactive", sql(f"""
    SELECT r.stream_name, r.source_table, c.last_activity,
           date_diff('hour', c.last_activity, {SQL_NOW}) AS hours_inactive
    FROM ({_REG_SQL}) r LEFT JOIN ({_stream_counts_sql()}) c USING (stream_name)
    WHERE date_diff('hour', c.last_activity, {SQL_NOW}) > 24""",
    "earnings_calls", "sec_filings", "stock_prices"))
def _mon_cdc_inactive(spark, sf_dir):
    counts = cdc.change_counts(_streams(spark, sf_dir), time_col="_loaded_at")
    return monitor.cdc_inactive(_registry(spark), counts, NOW)


@register("mon_job_history", f"""
    WITH log AS ({_RUNLOG})
    SELECT name AS task_name, completed_time, state, error_code FROM log
    WHERE completed_time >= {SQL_NOW} - INTERVAL 24 HOUR""")
def _mon_job_history(spark, sf_dir):
    return monitor.job_history(T(spark, sf_dir).run_log, NOW, 24)


@register("mon_signal_bounds", sql("""
    SELECT count(*) AS total_tickers,
           count(*) FILTER (WHERE composite_signal_score < -10 OR composite_signal_score > 10) AS out_of_bounds,
           min(composite_signal_score) AS min_score, max(composite_signal_score) AS max_score
    FROM mart_research_signals""", "mart_research_signals"))
def _mon_signal_bounds(spark, sf_dir):
    return monitor.signal_bounds(G(spark, sf_dir).get("mart_research_signals"))


@register("mon_return_bounds", sql("""
    SELECT count(*) AS total_records,
           count(*) FILTER (WHERE abs(post_earnings_5d_return_pct) > 50) AS extreme_moves,
           count(*) FILTER (WHERE post_earnings_5d_return_pct IS NULL) AS null_returns
    FROM mart_earnings_summary""", "mart_earnings_summary"))
def _mon_return_bounds(spark, sf_dir):
    return monitor.return_bounds(G(spark, sf_dir).get("mart_earnings_summary"))


_SCORECARD = [("Earnings Calls", "int_earnings_sentiment", "sentiment_score"),
              ("SEC Filings", "int_filing_classifications", "risk_category"),
              ("Stock Prices", "int_price_metrics", "close_price"),
              ("Research Signals", "mart_research_signals", "composite_signal_score")]


@register("mon_quality_scorecard", sql("\nUNION ALL\n".join(
    f"SELECT '{g}' AS metric_group, count(*) AS total_rows, count({c}) AS complete_rows, "
    f"{hu(f'CAST(count({c}) AS DOUBLE) * 100.0 / count(*)', 1)} AS completeness_pct FROM {t}"
    for g, t, c in _SCORECARD), *[t for _, t, _ in _SCORECARD]))
def _mon_quality_scorecard(spark, sf_dir):
    g = G(spark, sf_dir)
    return monitor.quality_scorecard({label: (g.get(t), c) for label, t, c in _SCORECARD})


# ======================================================================
# 2.10 alerts
# ======================================================================
def _alert_sql(severity: str, alert: str, measure_sql: str, threshold: float, fired: str, *ctes) -> str:
    m = hu(f"CAST(({measure_sql}) AS DOUBLE)", 6)
    return sql(f"SELECT '{severity}' AS severity, '{alert}' AS alert, m AS measure, "
               f"CAST({threshold} AS DOUBLE) AS threshold, coalesce({fired.format(m='m')}, false) AS fired "
               f"FROM (SELECT {m} AS m) t", *ctes)


@register("alert_feed_stale", _alert_sql(
    "critical", "alert_feed_stale", f"SELECT max(hours_since_latest) FROM ({_FRESH_SQL}) f", 6, "{m} > 6",
    "earnings_calls", "sec_filings", "stock_prices"))
def _alert_feed_stale(spark, sf_dir):
    return alerts.feed_stale(_fresh_tables(T(spark, sf_dir)), NOW)


@register("alert_sentiment_mean", _alert_sql(
    "critical", "alert_sentiment_mean", "SELECT avg(sentiment_score) FROM int_earnings_sentiment", 0.8,
    "({m} < -0.8 OR {m} > 0.8)", "int_earnings_sentiment"))
def _alert_sentiment_mean(spark, sf_dir):
    return alerts.sentiment_mean(G(spark, sf_dir).get("int_earnings_sentiment"))


@register("alert_embedding_dim", _alert_sql(
    "critical", "alert_embedding_dim",
    "SELECT count(*) FILTER (WHERE len([emb_1, emb_2, emb_3, emb_4, emb_5]) != 5) FROM ml_filing_embeddings",
    0, "{m} > 0", "ml_filing_embeddings"))
def _alert_embedding_dim(spark, sf_dir):
    return alerts.embedding_dim(G(spark, sf_dir).get("ml_filing_embeddings"))


@register("alert_zero_new_filings", _alert_sql(
    "critical", "alert_zero_new_filings",
    f"SELECT count(*) FILTER (WHERE CAST(filing_date AS TIMESTAMP) >= {SQL_NOW} - INTERVAL 48 HOUR) "
    "FROM sec_filings", 0, "{m} = 0", "sec_filings"))
def _alert_zero_new_filings(spark, sf_dir):
    return alerts.zero_new_filings(T(spark, sf_dir).sec_filings, NOW)


_FEEDS = [("earnings_calls", "call_date"), ("sec_filings", "filing_date"), ("stock_prices", "price_date")]


def _low_sql(tables) -> str:
    lows = " UNION ALL ".join(f"SELECT min(volume_ratio) AS m FROM ({_trend_sql(t, c)}) t" for t, c in tables)
    return f"SELECT min(m) FROM ({lows}) x"


@register("alert_volume_drop", _alert_sql("warning", "alert_volume_drop", _low_sql(_FEEDS), 0.5, "{m} < 0.5",
                                          *[t for t, _ in _FEEDS]))
def _alert_volume_drop(spark, sf_dir):
    """The lowest volume ratio of every raw feed."""
    raw = _raw_tables(spark, sf_dir)
    return alerts.volume_drop([(raw[t], c) for t, c in _FEEDS], AS_OF)


@register("alert_volume_drop_dip", _alert_sql("warning", "alert_volume_drop", _low_sql([(_ORDER_FEED_SQL, "call_date")]), 0.5,
                                              "{m} < 0.5"))
def _alert_volume_drop_dip(spark, sf_dir):
    """Fires on the feed with dipping days."""
    return alerts.volume_drop([(_order_feed(spark, sf_dir), "call_date")], AS_OF)


@register("alert_risk_surge", _alert_sql(
    "warning", "alert_risk_surge",
    f"SELECT CAST({_FLAG} AS DOUBLE) * 100.0 / count(*) FROM int_filing_classifications "
    f"WHERE filing_date >= {SQL_AS_OF} - 7", 60, "{m} > 60", "int_filing_classifications"))
def _alert_risk_surge(spark, sf_dir):
    return alerts.risk_surge(G(spark, sf_dir).get("int_filing_classifications"), AS_OF)


@register("alert_accuracy_drop", _alert_sql(
    "warning", "alert_accuracy_drop",
    f"SELECT CAST({_CONTRARY} AS DOUBLE) * 100.0 / count(*) FROM mart_earnings_summary", 30, "{m} > 30",
    "mart_earnings_summary"))
def _alert_accuracy_drop(spark, sf_dir):
    return alerts.accuracy_drop(G(spark, sf_dir).get("mart_earnings_summary"))


@register("alert_null_sentiment", _alert_sql(
    "warning", "alert_null_sentiment",
    "SELECT CAST(count(*) FILTER (WHERE sentiment_score IS NULL) AS DOUBLE) * 100.0 / count(*) "
    "FROM int_earnings_sentiment", 5, "{m} > 5", "int_earnings_sentiment"))
def _alert_null_sentiment(spark, sf_dir):
    return alerts.null_sentiment(G(spark, sf_dir).get("int_earnings_sentiment"))


# Two loads of the documents table: a column lost, one gained, one retyped.
_LOADS = ("SELECT doc_id, text, lang, n_chars FROM documents",
          "SELECT doc_id, text, source, CAST(n_chars AS DOUBLE) AS n_chars FROM documents")


@register("alert_schema_changed", _alert_sql("info", "alert_schema_changed", f"""
    SELECT count(*) FROM (SELECT column_name, column_type FROM (DESCRIBE {_LOADS[0]})) a
    FULL JOIN (SELECT column_name, column_type FROM (DESCRIBE {_LOADS[1]})) b USING (column_name)
    WHERE a.column_type IS DISTINCT FROM b.column_type""", 0, "{m} > 0"))
def _alert_schema_changed(spark, sf_dir):
    """A stored snapshot of one load against the snapshot of the next."""
    docs = T(spark, sf_dir).raw("documents")
    path = scratch_path(spark, "schema_snapshot")
    monitor.schema_snapshot(docs.select("doc_id", "text", "lang", "n_chars"), "documents").write.parquet(path)
    now = docs.select("doc_id", "text", "source", F.col("n_chars").cast("double").alias("n_chars"))
    return alerts.schema_changed(monitor.schema_snapshot(now, "documents"), spark.read.parquet(path))


_SHIFT_SQL = f"""
    SELECT arg_max(shift, price_date) FROM (
      SELECT price_date, {hu('abs((a - lag(a, 30) OVER (ORDER BY price_date)) / NULLIF(lag(a, 30) OVER (ORDER BY price_date), 0)) * 100.0', 2)} AS shift
      FROM (SELECT price_date, avg(CAST(n AS DOUBLE)) OVER (ORDER BY price_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS a
            FROM (SELECT CAST(o_orderdate AS DATE) AS price_date, count(*) AS n FROM orders GROUP BY 1) d) x) y"""


@register("alert_volume_trend_shift", _alert_sql("info", "alert_volume_trend_shift", _SHIFT_SQL, 20,
                                                 "{m} > 20"))
def _alert_volume_trend_shift(spark, sf_dir):
    """Over the orders feed, which has far more days than the lag."""
    orders = T(spark, sf_dir).raw("orders").select(F.to_date("o_orderdate").alias("price_date"))
    return alerts.volume_trend_shift(orders, "price_date")


@register("alert_new_ticker", _alert_sql(
    "info", "alert_new_ticker",
    "SELECT count(*) FROM (SELECT DISTINCT ticker FROM earnings_calls EXCEPT "
    "SELECT DISTINCT ticker FROM earnings_calls WHERE call_date < DATE '2024-01-20') n", 0, "{m} > 0",
    "earnings_calls"))
def _alert_new_ticker(spark, sf_dir):
    calls = T(spark, sf_dir).earnings_calls
    return alerts.new_ticker(calls, calls.filter(F.col("call_date") < F.lit(_dt.date(2024, 1, 20))))


# ======================================================================
# 2.11 expectations, tests, sanity checks
# ======================================================================
def _raw_tables(spark, sf_dir):
    t = T(spark, sf_dir)
    return {"earnings_calls": t.earnings_calls, "sec_filings": t.sec_filings, "stock_prices": t.stock_prices}


_DATE_COLS = {"price_date", "filing_date", "call_date"}


def _check_sql(table: str, i: int, c: quality.Check) -> str:
    col = f"'{c.column}'" if c.column else "CAST(NULL AS VARCHAR)"
    head = f"SELECT '{table}' AS table_name, {i} AS check_index, '{c.expectation}' AS expectation, {col} AS column_name"
    x = c.column

    def lit(v):
        return f"DATE '{v}'" if x in _DATE_COLS else repr(v)
    if c.kind == "row_count":
        return (f"{head}, count(*) AS evaluated, CAST(NULL AS BIGINT) AS unexpected, "
                f"count(*) BETWEEN {c.lo} AND {c.hi} AS success FROM {table}")
    if c.kind == "unique":
        return (f"{head}, coalesce(sum(n), 0)::BIGINT AS evaluated, "
                f"coalesce(sum(CASE WHEN n > 1 THEN n END), 0)::BIGINT AS unexpected, "
                f"coalesce(sum(CASE WHEN n > 1 THEN n END), 0) = 0 AS success "
                f"FROM (SELECT {x}, count(*) AS n FROM {table} WHERE {x} IS NOT NULL GROUP BY {x}) g")
    if c.kind == "not_null":
        ev, bad = "count(*)", f"{x} IS NULL"
    elif c.kind == "in_set":
        ev, bad = f"count({x})", f"{x} NOT IN ({', '.join(repr(v) for v in c.values)})"
    elif c.kind == "regex":
        ev, bad = f"count({x})", f"NOT regexp_matches({x}, '{c.pattern}')"
    elif c.kind == "between":
        ev, bad = f"count({x})", f"({x} < {lit(c.lo)} OR {x} > {lit(c.hi)})"
    elif c.kind == "length_between":
        ev, bad = f"count({x})", f"(length({x}) < {c.lo} OR length({x}) > {c.hi})"
    else:
        raise ValueError(c.kind)
    return (f"{head}, {ev} AS evaluated, count(*) FILTER (WHERE {bad}) AS unexpected, "
            f"count(*) FILTER (WHERE {bad}) = 0 AS success FROM {table}")


def _suite_sql(kind: str | None = None) -> str:
    parts = [_check_sql(t, i, c) for t, s in quality.SUITES.items() for i, c in enumerate(s)
             if kind is None or c.kind == kind]
    return sql("\nUNION ALL\n".join(parts), "earnings_calls", "sec_filings", "stock_prices")


for _kind, _qname in [("not_null", "expect_not_null"), ("unique", "expect_unique"),
                      ("in_set", "expect_in_set"), ("regex", "expect_match_regex"),
                      ("between", "expect_between"), ("length_between", "expect_length_between"),
                      ("row_count", "expect_row_count_between")]:
    register(_qname, _suite_sql(_kind))(
        (lambda k: lambda spark, sf_dir: quality.validate_kind(_raw_tables(spark, sf_dir), k))(_kind))


@register("suite_validate", _suite_sql())
def _suite_validate(spark, sf_dir):
    return quality.validate_all(_raw_tables(spark, sf_dir))


@register("quality_gate", f"""
    SELECT table_name, count(*) AS checks, count(*) FILTER (WHERE NOT success) AS failed_checks,
           count(*) FILTER (WHERE NOT success) = 0 AS passed FROM ({_suite_sql()}) r GROUP BY table_name""")
def _quality_gate(spark, sf_dir):
    """Gate rows (the pipeline raises on any failed row before staging)."""
    return quality.quality_gate(quality.validate_all(_raw_tables(spark, sf_dir)), raise_on_fail=False)


# a column of each kind as the number that is profiled
_PROFILED = {"price_id": "length(price_id)", "ticker": "length(ticker)", "price_date": "date_diff('day', DATE '1970-01-01', price_date)",
             **{c: c for c in ("open_price", "high_price", "low_price", "close_price", "adj_close_price", "volume")},
             "_loaded_at": "epoch_us(_loaded_at) / 1e6"}


@register("column_profile", sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null_count, count(*) - count({c}) AS null_count, "
    f"count(DISTINCT {c}) AS distinct_count, CAST(min({m}) AS DOUBLE) AS min_value, "
    f"CAST(max({m}) AS DOUBLE) AS max_value, {hu(f'avg({m})', 3)} AS mean_value, "
    f"{hu(f'stddev_samp({m})', 3)} AS stddev_value FROM stock_prices" for c, m in _PROFILED.items()), "stock_prices"))
def _column_profile(spark, sf_dir):
    p = quality.profile(T(spark, sf_dir).stock_prices, exact=True)
    return p.withColumns({"mean_value": half_up("mean_value", 3), "stddev_value": half_up("stddev_value", 3)})


@register("column_profile_merged", sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null_count, count(*) - count({c}) AS null_count, "
    f"CAST(min({m}) AS DOUBLE) AS min_value, CAST(max({m}) AS DOUBLE) AS max_value, {hu(f'avg({m})', 3)} AS mean_value "
    f"FROM stock_prices" for c, m in _PROFILED.items()), "stock_prices"))
def _column_profile_merged(spark, sf_dir):
    """Two loads profiled apart and merged from their sketches (the estimates
    of distinct values and quantiles are checked in the tests)."""
    prices, cut = T(spark, sf_dir).stock_prices, F.lit(_dt.date(2024, 1, 20))
    kept = scratch_path(spark, "profiles")
    for load, part in (("first", prices.filter(F.col("price_date") < cut)), ("second", prices.filter(F.col("price_date") >= cut))):
        profiles.profile_sketches(part, load).write.mode("append").parquet(kept)
    merged = profiles.estimates(profiles.merge_profiles(spark.read.parquet(kept)))
    return merged.select("column_name", "non_null_count", "null_count", "min_value", "max_value", half_up("mean_value", 3).alias("mean_value"))


# Suites that the driver tables pass or fail, as SQL over the same tables.
_GATES = {"reference": quality.SUITES, "keys": {"stock_prices": [
    quality.Check("not_null", "price_id"), quality.Check("unique", "price_id"), quality.Check("not_null", "ticker")]}}


def _gate_sql(name: str, suites) -> str:
    checks = "\nUNION ALL\n".join(_check_sql("stock_prices", i, c) for i, c in enumerate(suites["stock_prices"]))
    return (f"SELECT '{name}' AS suites, bool_and(success) AS passed, "
            f"CASE WHEN bool_and(success) THEN (SELECT count(*) FROM stg_stock_prices) ELSE 0 END AS staged_rows FROM ({checks}) c")


def _gated(spark, sf_dir, suites, group="prices") -> tuple[bool, int]:
    """Run the group behind the suites: did it pass, rows staged. Its tables
    go once these are known, so that several runs take the disk of one."""
    root = scratch_path(spark, "gated")
    try:
        found = True, run_pipeline(G(spark, sf_dir), group, root, gate=suites)[GROUPS[group][0]].count()
    except quality.QualityGateError:
        staged = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/staging")
        fs = staged.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = False, -1 if fs.exists(staged) else 0
    drop_scratch(spark, root)
    return found


@register("pipeline_gate", sql("\nUNION ALL\n".join(_gate_sql(n, s) for n, s in _GATES.items()), "stock_prices", "stg_stock_prices"))
def _pipeline_gate(spark, sf_dir):
    """A failing gate leaves nothing staged, a passing one stages the table."""
    rows = [(name, *_gated(spark, sf_dir, {"stock_prices": suites["stock_prices"]})) for name, suites in _GATES.items()]
    return spark.createDataFrame(rows, "suites string, passed boolean, staged_rows long")


_TABLE_KEYS = {t: [quality.Check("not_null", c), quality.Check("unique", c), quality.Check("not_null", "ticker")]
               for t, c in [("earnings_calls", "call_id"), ("sec_filings", "filing_id"), ("stock_prices", "price_id")]}
# with "reference_texts" only the calls and the filings can stop a group
_GROUP_GATES = {"reference": quality.SUITES, "keys": _TABLE_KEYS,
                "reference_texts": {**quality.SUITES, "stock_prices": _TABLE_KEYS["stock_prices"]}}
_GATED_GROUPS = ("prices", "earnings", "filings")


def _group_gate_sql(group: str, name: str) -> str:
    checks = "\nUNION ALL\n".join(_check_sql(t, i, c) for t in raw_inputs(group) for i, c in enumerate(_GROUP_GATES[name][t]))
    return (f"SELECT '{group}' AS refresh_group, '{name}' AS suites, bool_and(success) AS passed, CASE WHEN bool_and(success) "
            f"THEN (SELECT count(*) FROM {GROUPS[group][0]}) ELSE 0 END AS staged_rows FROM ({checks}) c")


@register("pipeline_gate_groups", sql("\nUNION ALL\n".join(_group_gate_sql(g, n) for g in _GATED_GROUPS for n in _GROUP_GATES),
                                      "earnings_calls", "sec_filings", "stock_prices", *[GROUPS[g][0] for g in _GATED_GROUPS]))
def _pipeline_gate_groups(spark, sf_dir):
    """Every group behind the suites of all raw tables that it reads."""
    rows = [(g, n, *_gated(spark, sf_dir, suites, g)) for g in _GATED_GROUPS for n, suites in _GROUP_GATES.items()]
    return spark.createDataFrame(rows, "refresh_group string, suites string, passed boolean, staged_rows long")


def _row_check_sql(c: quality.Check) -> str | None:
    """A row fails the check (null: it does not)."""
    found = re.search(r"FILTER \(WHERE (.*)\) AS unexpected", _check_sql("t", 0, c))
    return found[1] if found and c.kind not in ("row_count", "unique") else None


def _gate_write_sql(t: str) -> str:
    bad = " OR ".join(f"coalesce({x}, false)" for c in quality.SUITES[t] if (x := _row_check_sql(c)))
    checks = "\nUNION ALL\n".join(_check_sql(t, i, c) for i, c in enumerate(quality.SUITES[t]))
    return (f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS total_rows, (SELECT count(*) FROM {t} WHERE NOT ({bad})) AS clean_rows, "
            f"(SELECT count(*) FROM {t} WHERE {bad}) AS quarantined_rows, count(*) AS checks, "
            f"count(*) FILTER (WHERE NOT success) AS failed_checks FROM ({checks}) c")


@register("quality_gate_write", sql("\nUNION ALL\n".join(map(_gate_write_sql, quality.SUITES)), *quality.SUITES))
def _quality_gate_write(spark, sf_dir):
    """Each raw table written once behind its suite: what is clean, what is
    quarantined, which checks failed."""
    parts = []
    for name, df in _raw_tables(spark, sf_dir).items():
        g = gated.write_gated(df, name, quality.SUITES[name], scratch_path(spark, "gated_write"))
        counts = g.clean.agg(F.count(F.lit(1)).alias("clean_rows")).join(
            g.quarantined.agg(F.count(F.lit(1)).alias("quarantined_rows")), F.lit(True)).join(
            g.results.agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("success")).alias("failed_checks")), F.lit(True))
        parts.append(counts.select(F.lit(name).alias("table_name"), (F.col("clean_rows") + F.col("quarantined_rows")).alias("total_rows"),
                                   "clean_rows", "quarantined_rows", "checks", "failed_checks"))
    return union_all(parts)


@register("quality_gate_write_checks", sql("\nUNION ALL\n".join(
    f"SELECT table_name, check_index, expectation, column_name, CAST(evaluated AS DOUBLE) AS evaluated, CAST(unexpected AS DOUBLE) AS unexpected, success "
    f"FROM ({_check_sql(t, i, c)}) x" for t, suite in quality.SUITES.items() for i, c in enumerate(suite)), *quality.SUITES))
def _quality_gate_write_checks(spark, sf_dir):
    """The checks as counted while writing, micro-batch by micro-batch (here one), equal those of a scan."""
    parts = []
    for name, df in _raw_tables(spark, sf_dir).items():
        root = scratch_path(spark, "gated_stream")
        df.write.parquet(f"{root}/feed")
        stream = spark.readStream.schema(df.schema).parquet(f"{root}/feed")
        gated.gated_stream(stream, name, quality.SUITES[name], f"{root}/target", f"{root}/ckpt", trigger={"availableNow": True}).awaitTermination()
        parts.append(gated.read_gated_stream(spark, f"{root}/target", df.columns)[2].drop("batch"))
    checks = union_all(parts)
    return checks.withColumns({c: F.col(c).cast("double") for c in ("evaluated", "unexpected")})


# ------------------------------------------------- the six quiet checks, with hits
@register("test_unique_hits", """
    SELECT l_orderkey AS value, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1
    UNION ALL
    SELECT o_orderkey, count(*) FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1""")
def _test_unique_hits(spark, sf_dir):
    """Line items repeat their order's key (hits); orders don't (quiet)."""
    t = T(spark, sf_dir)
    return union_all([quality.test_unique(t.raw(name), c).select(F.col(c).alias("value"), "n_records")
                      for name, c in (("lineitem", "l_orderkey"), ("orders", "o_orderkey"))])


@register("test_not_null_hits", sql("""
    SELECT 'confidence_score' AS column_name, call_id AS row_key FROM earnings_calls WHERE confidence_score IS NULL
    UNION ALL SELECT 'call_date', call_id FROM earnings_calls WHERE call_date IS NULL""", "earnings_calls"))
def _test_not_null_hits(spark, sf_dir):
    calls = T(spark, sf_dir).earnings_calls
    return union_all([quality.test_not_null(calls, c).select(F.lit(c).alias("column_name"), F.col("call_id").alias("row_key"))
                      for c in ("confidence_score", "call_date")])


@register("test_sentiment_range_hits", """
    SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08""")
def _test_sentiment_range_hits(spark, sf_dir):
    """The range test on a column that leaves its range."""
    return quality.test_range(T(spark, sf_dir).raw("lineitem"), "l_discount", 0.02, 0.08, keep=("l_orderkey", "l_linenumber", "l_discount"))


@register("mon_score_outliers_hits", sql(f"""
    SELECT e.filing_id, e.ticker, CAST(e.file_size_kb AS DOUBLE) AS score,
           {hu('abs(e.file_size_kb - s.m) / NULLIF(s.sd, 0)', 2)} AS z_score
    FROM sec_filings e, (SELECT avg(file_size_kb) AS m, stddev_samp(file_size_kb) AS sd FROM sec_filings) s
    WHERE abs(e.file_size_kb - s.m) / NULLIF(s.sd, 0) > 3""", "sec_filings"))
def _mon_score_outliers_hits(spark, sf_dir):
    """Filings of unusual size."""
    filings = T(spark, sf_dir).sec_filings.withColumn("score", F.col("file_size_kb").cast("double"))
    return monitor.score_outliers(filings, "score", keep=("filing_id", "ticker"))


@register("mon_cdc_inactive_hits", sql(f"""
    SELECT r.stream_name, r.source_table, c.last_activity, date_diff('hour', c.last_activity, {SQL_NOW} + INTERVAL 3 DAY) AS hours_inactive
    FROM ({_REG_SQL}) r LEFT JOIN ({_stream_counts_sql()}) c USING (stream_name)
    WHERE date_diff('hour', c.last_activity, {SQL_NOW} + INTERVAL 3 DAY) > 24""", "earnings_calls", "sec_filings", "stock_prices"))
def _mon_cdc_inactive_hits(spark, sf_dir):
    """Three days later every stream with a last activity counts as inactive."""
    counts = cdc.change_counts(_streams(spark, sf_dir), time_col="_loaded_at")
    return monitor.cdc_inactive(_registry(spark), counts, NOW + _dt.timedelta(days=3))


# ------------------------------------------------------- monitors over real runs
def _broken(batch: DataFrame, batch_id: int) -> None:
    raise ValueError("price feed has no header")


def _run_streams(spark, sf_dir) -> DataFrame:
    """The run log that three streams over the driver tables wrote: one of two
    drops, one of a single drop, one that fails."""
    t, root = T(spark, sf_dir), scratch_path(spark, "run_log")
    feeds = {"dt_earnings_sentiment": t.earnings_calls.select("call_id", "ticker", "call_date"),
             "dt_filing_risk_signals": t.sec_filings.select("filing_id", "ticker", "filing_date"),
             "dt_price_summary": t.stock_prices.select("price_id", "ticker", "price_date")}

    def run(name: str, drop: int) -> None:
        df = feeds[name]
        df.write.parquet(f"{root}/{name}/feed/d{drop}")
        w = (spark.readStream.schema(df.schema).parquet(f"{root}/{name}/feed/*").writeStream.queryName(name)
             .option("checkpointLocation", f"{root}/{name}/ckpt").trigger(availableNow=True))
        w = w.foreachBatch(_broken) if name == "dt_price_summary" else w.format("parquet").option("path", f"{root}/{name}/out")
        try:
            w.start().awaitTermination()
        except StreamingQueryException:
            if name != "dt_price_summary":
                raise

    with progress.RunLog(spark, f"{root}/log"):
        for name, drop in (("dt_earnings_sentiment", 0), ("dt_filing_risk_signals", 0), ("dt_earnings_sentiment", 1), ("dt_price_summary", 0)):
            run(name, drop)
    return progress.read_runs(spark, f"{root}/log")


_STREAM_RUNS_SQL = """
    SELECT 'dt_earnings_sentiment' AS table_name, 'SUCCEEDED' AS state, '5 minutes' AS target_lag, 'NEW_DATA' AS refresh_reason, 2 AS runs,
           2 * count(*) AS input_rows, false AS failed FROM earnings_calls
    UNION ALL SELECT 'dt_filing_risk_signals', 'SUCCEEDED', '10 minutes', 'INITIAL', 1, count(*), false FROM sec_filings
    UNION ALL SELECT 'dt_price_summary', 'FAILED', '1 minute', 'FAILED', 1, 0, true"""


@register("mon_refresh_health_runs", sql(_STREAM_RUNS_SQL, "earnings_calls", "sec_filings"))
def _mon_refresh_health_runs(spark, sf_dir):
    """Health of three streams from the log that a listener wrote."""
    health = monitor.run_health(_run_streams(spark, sf_dir), _dt.datetime.now(_dt.UTC).replace(tzinfo=None), refresh.TARGET_LAG)
    return health.select("table_name", "state", "target_lag", "refresh_reason", "runs", "input_rows",
                         F.coalesce(F.contains("last_error", F.lit("price feed has no header")), F.lit(False)).alias("failed"))


@register("mon_refresh_stuck_runs", "SELECT 'dt_earnings_sentiment' AS table_name, 'SUCCEEDED' AS state UNION ALL "
          "SELECT 'dt_filing_risk_signals', 'SUCCEEDED' UNION ALL SELECT 'dt_price_summary', 'FAILED'")
def _mon_refresh_stuck_runs(spark, sf_dir):
    """Eight hours after their last run all three count as stuck."""
    later = _dt.datetime.now(_dt.UTC).replace(tzinfo=None) + _dt.timedelta(hours=8)
    return monitor.refresh_stuck(_run_streams(spark, sf_dir), later).select("table_name", "state")


@register("mon_job_history_runs", """
    SELECT 'dt_earnings_sentiment' AS task_name, 2 AS runs, 0 AS failed_runs, NULL AS error_code UNION ALL
    SELECT 'dt_filing_risk_signals', 1, 0, NULL UNION ALL SELECT 'dt_price_summary', 1, 1, 'told'""")
def _mon_job_history_runs(spark, sf_dir):
    """The seven-day view of the same log."""
    now = _dt.datetime.now(_dt.UTC).replace(tzinfo=None) + _dt.timedelta(hours=1)
    told = F.when(F.col("error_code").isNotNull() & F.contains("error_message", F.lit("price feed")), "told")
    return monitor.job_summary(_run_streams(spark, sf_dir), now).select("task_name", "runs", "failed_runs", told.alias("error_code"))


_IDS = [("earnings_calls", "call_id"), ("sec_filings", "filing_id"), ("stock_prices", "price_id")]


@register("test_unique", sql("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS n_records FROM {t} "
    f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1" for t, c in _IDS),
    "earnings_calls", "sec_filings", "stock_prices"))
def _test_unique(spark, sf_dir):
    t = _raw_tables(spark, sf_dir)
    return union_all([quality.test_unique(t[n], c).select(F.lit(n).alias("table_name"),
                                                          F.lit(c).alias("column_name"),
                                                          F.col(c).alias("value"), "n_records")
                      for n, c in _IDS])


_NN = [("earnings_calls", "call_id", "call_id"), ("earnings_calls", "ticker", "call_id"),
       ("earnings_calls", "call_date", "call_id"), ("sec_filings", "filing_id", "filing_id"),
       ("stock_prices", "price_id", "price_id")]


@register("test_not_null", sql("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({k} AS VARCHAR) AS row_key FROM {t} "
    f"WHERE {c} IS NULL" for t, c, k in _NN), "earnings_calls", "sec_filings", "stock_prices"))
def _test_not_null(spark, sf_dir):
    t = _raw_tables(spark, sf_dir)
    return union_all([quality.test_not_null(t[n], c).select(F.lit(n).alias("table_name"),
                                                            F.lit(c).alias("column_name"),
                                                            F.col(k).cast("string").alias("row_key"))
                      for n, c, k in _NN])


@register("test_sentiment_range", sql("""
    SELECT ticker, call_date, sentiment_score, speaker_name, speaker_role FROM int_earnings_sentiment
    WHERE sentiment_score < -1.0 OR sentiment_score > 1.0""", "int_earnings_sentiment"))
def _test_sentiment_range(spark, sf_dir):
    return quality.test_range(G(spark, sf_dir).get("int_earnings_sentiment"))


@register("check_row_counts", sql("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in ("earnings_calls", "sec_filings", "stock_prices")), "earnings_calls", "sec_filings", "stock_prices"))
def _check_row_counts(spark, sf_dir):
    return quality.row_counts(_raw_tables(spark, sf_dir))


@register("check_date_ranges", sql("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, min({c}) AS min_date, max({c}) AS max_date FROM {t}"
    for t, c in (("earnings_calls", "call_date"), ("sec_filings", "filing_date"), ("stock_prices", "price_date"))),
    "earnings_calls", "sec_filings", "stock_prices"))
def _check_date_ranges(spark, sf_dir):
    return quality.date_ranges({k: v for k, v in _fresh_tables(T(spark, sf_dir)).items()})


@register("check_ticker_coverage", sql(
    "SELECT ticker, count(*) AS record_count FROM earnings_calls GROUP BY ticker ORDER BY 2 DESC, 1",
    "earnings_calls"))
def _check_ticker_coverage(spark, sf_dir):
    return quality.coverage(T(spark, sf_dir).earnings_calls, "ticker")


# ======================================================================
# training-data operators (a separate subpackage that may be absent)
# ======================================================================
try:
    _llm = importlib.import_module("tidemark.llm.queries")
except ModuleNotFoundError as _absent:
    if _absent.name not in ("tidemark.llm", "tidemark.llm.queries", "corpus_pipeline"):
        raise
else:
    for _name, _fn in _llm.QUERIES.items():
        register(_name, _llm.ORACLE_SQL.get(_name))(_fn)


# ======================================================================
# contract
# ======================================================================
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the research-signals mart on the sf0.001 driver tables."""
    ensure_checkpoint_dir(spark)
    return G(spark, SMOKE_DIR).get("mart_research_signals")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: fn for k, (fn, _) in _REG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in _REG.items() if s is not None}
