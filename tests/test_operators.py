"""Operator semantics on small inline fixtures in the raw schemas: staging
boundaries, windows (plain vs skew-spread), event-window joins vs brute
force, marts, governance, CDC invariants, scenarios, expectations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.functions.numeric import half_up
from tidemark.operators import (cdc, governance as gov, indicators, joins, marts, quality,
                                retrieval, staging)
from tidemark.plans.graph import ModelGraph
from tidemark.operators import scenario
from tidemark.sources import schemas

D = dt.date
AS_OF = D(2025, 9, 1)
NOW = dt.datetime(2025, 9, 1, 12)


def calls(spark, rows_):
    base = {"company_name": "Co", "call_type": "Earnings Call", "quarter": 2, "fiscal_year": 2025,
            "speaker_name": " Jane ", "confidence_score": None, "_loaded_at": None}
    data = [{**base, **r} for r in rows_]
    return spark.createDataFrame(data, schemas.EARNINGS_CALLS)


def bars(spark, spec):
    """spec: list of (ticker, date, open, close)."""
    data = [(f"{t}-{d}", t, d, o, float(max(o or 0, c or 0)), float(min(o or 0, c or 0)), c, c, 100,
             None) for t, d, o, c in spec]
    return spark.createDataFrame(data, schemas.STOCK_PRICES)


def test_stg_earnings_length_and_defaults(spark):
    t50, t51 = "x" * 50, "y" * 51
    padded = " " + "z" * 49 + " "                      # raw length 51, trimmed 49
    df = calls(spark, [
        {"call_id": "a", "ticker": " aapl ", "call_date": D(2025, 1, 1), "speaker_role": "CEO", "transcript_text": t50},
        {"call_id": "b", "ticker": "msft", "call_date": D(2025, 1, 1), "speaker_role": "CEO", "transcript_text": t51},
        {"call_id": "c", "ticker": "x", "call_date": D(2025, 1, 1), "speaker_role": "CEO", "transcript_text": padded},
        {"call_id": "d", "ticker": "x", "call_date": D(2020, 1, 1), "speaker_role": "CEO", "transcript_text": t51},
        {"call_id": "e", "ticker": "x", "call_date": D(2025, 1, 1), "speaker_role": "CEO", "transcript_text": None},
    ])
    out = staging.stg_earnings_calls(df, AS_OF)
    got = {r.call_id: r for r in out.collect()}
    assert set(got) == {"b", "c"}
    assert got["b"].ticker == "MSFT" and got["b"].confidence_score == 0.85
    assert got["c"].transcript_text == "z" * 49 and got["c"].speaker_name == "Jane"


def test_stg_prices_returns(spark):
    df = bars(spark, [("A", D(2025, 8, 1), 0.0, 1.0), ("A", D(2025, 8, 2), None, 1.0),
                      ("A", D(2025, 8, 3), 2.0, None), ("A", D(2025, 8, 4), 2.0, 3.0)])
    got = {r.price_date: r.daily_return_pct for r in staging.stg_stock_prices(df, AS_OF).collect()}
    assert got[D(2025, 8, 1)] is None and got[D(2025, 8, 2)] is None and got[D(2025, 8, 3)] is None
    assert got[D(2025, 8, 4)] == pytest.approx(0.5)


def _series(spark, n_hot=300, n_cold=5):
    spec = []
    for i in range(n_hot):
        d = D(2020, 1, 1) + dt.timedelta(days=i)
        spec.append(("HOT", d, 10 + (i % 7) * 0.1, 10 + (i % 11) * 0.13))
    for i in range(n_cold):
        spec.append(("COLD", D(2025, 1, 1) + dt.timedelta(days=i), 5.0, 5.0))   # constant returns
    spec.append(("ONE", D(2025, 1, 1), 1.0, 2.0))
    return staging.stg_stock_prices(bars(spark, spec), D(2025, 12, 31), years=10)


def test_spread_windows_equal_plain(spark):
    stg = _series(spark)
    specs = [("ma", indicators.moving_avg(20)), ("ml", indicators.moving_avg(50)),
             ("v", indicators.rolling_stddev(20))]
    plain = indicators.rolling(stg, "ticker", "price_date", specs, 49, tie="price_id")
    spread = indicators.rolling(stg, "ticker", "price_date", specs, 49, spread=True, tie="price_id",
                                run_rows=64)        # many runs per hot ticker, halos crossing runs
    cols = ["ticker", "price_date", "ma", "ml", "v"]
    assert rows(plain, cols) == rows(spread, cols)
    # runs shorter than the halo, day buckets: halos then span several runs
    tiny = indicators.rolling(stg, "ticker", "price_date", specs, 49, spread=True, tie="price_id",
                              run_rows=10, grain="day")
    assert rows(plain, cols) == rows(tiny, cols)


def test_price_metrics_edges(spark):
    stg = _series(spark)
    m = {(r.ticker, r.price_date): r for r in indicators.int_price_metrics(stg).collect()}
    one = m[("ONE", D(2025, 1, 1))]
    assert one.volatility_20d is None and one.sharpe_like_ratio is None and one.ma_50d == 2.0
    cold = m[("COLD", D(2025, 1, 5))]
    assert cold.volatility_20d == 0.0 and cold.sharpe_like_ratio is None


def test_event_window_join_matches_brute_force(spark):
    b = staging.stg_stock_prices(bars(spark, [
        ("A", D(2025, 1, d), 10.0, 10.0 + d) for d in (1, 2, 6, 7, 11, 12)]), AS_OF)
    ev = spark.createDataFrame([("e1", "A", D(2025, 1, 1)), ("e2", "A", D(2025, 1, 20)),
                                ("e3", "B", D(2025, 1, 1))], "call_id string, ticker string, call_date date")
    for lo, hi, how in [(0, 5, "left"), (1, 10, "inner"), (0, 5, "inner")]:
        got = joins.event_window_join(ev, b, lo, hi, how)
        bb = b.select(F.col("ticker").alias("t2"), "price_date", "daily_return_pct")
        cond = ((F.col("ticker") == F.col("t2")) & (F.col("price_date") >= F.date_add("call_date", lo))
                & (F.col("price_date") <= F.date_add("call_date", hi)))
        brute = ev.join(bb, cond, how).drop("t2")
        cols = ["call_id", "ticker", "call_date", "price_date", "daily_return_pct"]
        assert rows(got, cols) == rows(brute, cols), (lo, hi, how)
    left = {(r.call_id, r.price_date) for r in joins.event_window_join(ev, b, 0, 5, "left").collect()}
    assert ("e1", D(2025, 1, 6)) in left and ("e1", D(2025, 1, 7)) not in left
    assert ("e2", None) in left and ("e3", None) in left


def test_earnings_summary_no_price_is_contrary(spark):
    e = spark.createDataFrame([("A", D(2025, 1, 1), 0.5, "Co", 1, 2025)],
                              "ticker string, call_date date, sentiment_score double, company_name string, "
                              "quarter int, fiscal_year int")
    b = staging.stg_stock_prices(bars(spark, [("Z", D(2025, 1, 1), 1.0, 2.0)]), AS_OF)
    r = marts.mart_earnings_summary(e, b).first()
    assert r.prediction_accuracy == "Contrary Signal" and r.post_earnings_5d_return_pct == 0.0


def test_filing_dashboard_risk_level_boundaries(spark):
    def fil(n, flagged):
        return [("T", "10-K", 2025, 1, "LITIGATION_RISK" if i < flagged else "OPERATIONAL", "NEUTRAL", "abc")
                for i in range(n)]
    data = fil(5, 2) + [(t, "10-Q", y, q, c, p, s) for t, _, y, q, c, p, s in fil(5, 1)] \
        + [(t, "8-K", y, q, c, p, s) for t, _, y, q, c, p, s in fil(5, 3)]
    df = spark.createDataFrame(data, "ticker string, filing_type string, fiscal_year int, fiscal_quarter int, "
                                     "risk_category string, sentiment_polarity string, section_text string")
    got = {r.filing_type: r.risk_level for r in marts.mart_filing_dashboard(df).collect()}
    assert got == {"10-K": "MEDIUM_RISK", "10-Q": "LOW_RISK", "8-K": "HIGH_RISK"}


def test_masks_every_role(spark):
    df = spark.createDataFrame([("t" * 150, None, [1.0] * 5, 25), ("short", 0.6, [2.0] * 5, 34)],
                               "t string, s double, v array<double>, f bigint")
    for role in gov.ROLES:
        r = df.select(gov.mask_transcript(F.col("t"), role).alias("t"), gov.mask_sentiment(F.col("s"), role).alias("s"),
                      gov.mask_embedding(F.col("v"), role).alias("v"),
                      gov.mask_file_size(F.col("f"), role).alias("f")).collect()
        if role in gov.FULL_TEXT_ROLES:
            assert r[0].t == "t" * 150
        elif role in gov.SECTOR_ROLES:
            assert r[1].t == "short... [REDACTED - 5 total characters]"
        else:
            assert r[0].t == "t" * 100 + "... [REDACTED - Contact administrator for full access]"
        if role in gov.EXACT_SCORE_ROLES:
            assert r[0].s is None and r[1].s == 0.6
        else:
            assert r[0].s == -0.75 and r[1].s == 0.75          # NULL falls to the ELSE bucket
        assert r[0].v == ([1.0] * 5 if role in gov.VECTOR_ROLES else [0.0] * 5)
        assert [x.f for x in r] == ([25, 34] if role == gov.ADMIN else [30, 30])


def test_row_access_and_secure_view(spark):
    df = spark.createDataFrame([("AAPL", 0.9), ("TSLA", -0.9), ("XOM", 0.1)], "ticker string, ceo_sentiment double")
    for role, want in [(gov.ADMIN, {"AAPL", "TSLA", "XOM"}), (gov.ANALYST, {"AAPL", "TSLA", "XOM"}),
                       (gov.SECTOR_TECH, {"AAPL"}), (gov.SECTOR_ENERGY, {"TSLA"}), ("NOBODY", set())]:
        got = {r.ticker for r in gov.row_access(df, role).collect()}
        assert got == want and got <= {"AAPL", "TSLA", "XOM"}
    sv = gov.secure_view(df, "mart_research_signals", gov.SECTOR_TECH).collect()
    assert [(r.ticker, r.ceo_sentiment) for r in sv] == [("AAPL", 0.75)]
    assert rows(gov.secure_view(df, "mart_research_signals", gov.ADMIN)) == rows(df)


def _orders(spark, data):
    return spark.createDataFrame(data, "k long, a string, b double")


def test_cdc_invariants(spark):
    A = _orders(spark, [(1, "x", 1.0), (2, "y", None), (3, "z", 3.0)])
    B = _orders(spark, [(1, "x", 1.0), (2, "y", 2.0), (4, "w", 4.0)])
    assert cdc.cdc_changes(A, A, "k").count() == 0
    ch = cdc.cdc_changes(A, B, "k")
    got = sorted((r.k, r.action, r.is_update) for r in ch.collect())
    assert got == [(2, "DELETE", True), (2, "INSERT", True), (3, "DELETE", False), (4, "INSERT", False)]
    assert rows(cdc.apply_changes(A, ch, "k")) == rows(B)


def test_upsert_semantics(spark):
    target = _orders(spark, [(1, "x", 1.0), (2, "y", 2.0)])
    ch = _orders(spark, [(2, "Y", 20.0), (5, "n", 5.0)]).withColumn("action", F.lit("INSERT"))
    out = {r.k: (r.a, r.b) for r in cdc.upsert(target, ch, "k", ["b"]).collect()}
    assert out == {1: ("x", 1.0), 2: ("y", 20.0), 5: ("n", 5.0)}   # only b updated on match


def test_dedup_latest_hot_key(spark):
    data = [(1, i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(500)] + [(2, 7, None)]
    df = spark.createDataFrame(data, "k long, v long, ts timestamp").repartition(8)
    got = {r.k: r.v for r in staging.dedup_latest(df, "k", "ts").collect()}
    assert got == {1: 499, 2: 7}


def _graph(spark):
    c = calls(spark, [{"call_id": f"c{i}", "ticker": "AAA", "call_date": D(2025, 8, 1 + i), "speaker_role": "CEO",
                       "transcript_text": ("record revenue " if i == 2 else "headwinds ") + "x" * 60}
                      for i in range(3)])
    f = spark.createDataFrame([("f1", "AAA", "Co", "10-K", D(2025, 8, 20), D(2025, 6, 30), "t", "lawsuit" * 20,
                                "1A", 3, 100, None)], schemas.SEC_FILINGS)
    b = bars(spark, [("AAA", D(2025, 7, 1) + dt.timedelta(days=i), 10.0 + i % 3, 10.5 + i % 5) for i in range(60)])
    return ModelGraph({"earnings_calls": c, "sec_filings": f, "stock_prices": b}, AS_OF, NOW)


def test_research_signals_and_scenarios(spark):
    g = _graph(spark)
    base = g.get("mart_research_signals").collect()
    assert len(base) == 1 and base[0].ceo_sentiment == 0.85 and base[0].high_risk_count == 1
    same = scenario.stress_scenario(g, 1.0, 0.0).get("mart_research_signals")
    assert rows(same) == rows(g.get("mart_research_signals"))
    cmp = scenario.scenario_compare(g.get("mart_research_signals"),
                                    scenario.stress_scenario(g, 0.6, -0.2).get("mart_research_signals")).first()
    stressed = 0.85 * 0.6 - 0.2
    assert cmp.delta == pytest.approx(cmp.baseline - cmp.stress_test)
    assert cmp.baseline - cmp.stress_test == pytest.approx((0.85 - stressed) * 10, abs=0.011)
    assert rows(g.get("mart_research_signals")) == rows(g.with_overrides({}).get("mart_research_signals"))


def test_cosine_topk_excludes_target(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, [-1.0, 0.0])],
                              "id long, e array<double>")
    got = [(r.id, r.cosine_similarity) for r in retrieval.cosine_topk(v, "id", "e", 0, k=2).collect()]
    assert got[0][0] == 1 and got[1] == (2, 0.0) and 0 not in [i for i, _ in got]


def test_expectation_suite_on_seed_shape(spark):
    df = calls(spark, [
        {"call_id": "EC-001", "ticker": "AAPL", "call_date": D(2025, 1, 1), "speaker_role": "CEO",
         "transcript_text": "t" * 60, "confidence_score": 0.9},
        {"call_id": "EC-002", "ticker": "aapl", "call_date": D(2025, 1, 2), "speaker_role": "CFO",
         "transcript_text": "t" * 60, "confidence_score": 1.0},
    ])
    res = {(r.expectation, r.column_name): r for r in quality.validate(df, "earnings_calls",
                                                                       quality.SUITES["earnings_calls"]).collect()}
    regex = res[("expect_column_values_to_match_regex", "ticker")]
    assert (regex.unexpected, regex.success) == (1, False)            # lower-case ticker
    in_set = res[("expect_column_values_to_be_in_set", "call_type")]
    assert (in_set.unexpected, in_set.success) == (2, False)          # seed 'Earnings Call' (D7)
    assert res[("expect_column_values_to_be_between", "confidence_score")].success   # inclusive bound
    rc = res[("expect_table_row_count_to_be_between", None)]
    assert (rc.evaluated, rc.success) == (2, False)
    with pytest.raises(quality.QualityGateError):
        quality.quality_gate(quality.validate(df, "earnings_calls", quality.SUITES["earnings_calls"]))


def test_unique_expectation_counts_duplicated_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "filing_id string")
    r = quality.validate(df, "t", [quality.Check("unique", "filing_id")]).first()
    assert (r.evaluated, r.unexpected, r.success) == (3, 2, False)


def test_half_up_column_profile(spark):
    df = spark.createDataFrame([(1.0, 1), (3.0, None)], "a double, b long")
    p = {r.column_name: r for r in quality.profile(df, exact=True).collect()}
    assert p["a"].mean_value == 2.0 and p["b"].null_count == 1 and p["a"].distinct_count == 2
    assert half_up


def test_latest_price_metrics_equals_full_history(spark):
    spec = [("A", D(2024, 1, 1) + dt.timedelta(days=i), 10.0 + i % 3, 10.0 + i % 4) for i in range(120)]
    # ticker B: the last 60 closes are NULL, so its latest surviving metrics row is older
    spec += [("B", D(2024, 1, 1) + dt.timedelta(days=i), 5.0, (5.0 + i % 2) if i < 60 else None)
             for i in range(120)]
    spec += [("C", D(2024, 3, 1), 1.0, 1.5)]
    stg = staging.stg_stock_prices(bars(spark, spec), D(2025, 1, 1))
    full = indicators.latest_per_key(indicators.int_price_metrics(stg), "ticker", "price_date")
    fast = indicators.latest_price_metrics(stg)
    assert rows(fast, full.columns) == rows(full)
    assert {r.ticker: r.price_date for r in fast.collect()}["B"] == D(2024, 1, 1) + dt.timedelta(days=108)


def test_pandas_scorer_plugin(spark):
    """A batch model plugged in through an iterator pandas UDF (loaded once
    per task); the default path stays the JVM rule compiler."""
    from tidemark.operators import enrich

    def make_model():
        return lambda texts: texts.str.len().astype("float64") / 100.0

    df = spark.createDataFrame([("a", "x" * 50), ("b", "y" * 120)], "call_id string, transcript_text string")
    got = {r.call_id: r.s for r in enrich.score_with_model(df, "transcript_text", "s",
                                                           enrich.pandas_scorer(make_model)).collect()}
    assert got == {"a": 0.5, "b": 1.2}
    default = enrich.score_with_model(df.withColumn("transcript_text", F.lit("record revenue")),
                                      "transcript_text", "s")
    assert {r.s for r in default.collect()} == {0.85}


def test_embeddings_tfidf_and_model_plugin(spark):
    from tidemark.operators import embeddings
    df = spark.createDataFrame([("d1", "alpha beta beta"), ("d2", "gamma"), ("d3", "alpha gamma")],
                               "doc string, text string")
    tfidf = {r.doc: r.embedding for r in embeddings.embed_text(df, "text", "doc", dim=32).collect()}
    assert all(len(v) == 32 for v in tfidf.values())
    assert all(abs(sum(x * x for x in v) - 1.0) < 1e-9 for v in tfidf.values())   # L2-normalised

    def make_model():
        return lambda texts: [[float(len(t)), float(t.count("a"))] for t in texts]
    got = {r.doc: r.embedding for r in embeddings.embed_with_model(df, "text", "doc", make_model).collect()}
    assert got == {"d1": [15.0, 4.0], "d2": [5.0, 2.0], "d3": [11.0, 4.0]}


def test_pipeline_quality_gate_stops_before_staging(spark):
    from helpers import SF_SMALL
    from tidemark.functions.rules import FIXTURE
    from tidemark.plans.graph import graph_from_driver
    from tidemark.plans.pipeline import run_pipeline
    from tidemark.session import scratch_path
    g = graph_from_driver(spark, SF_SMALL, FIXTURE)
    root = scratch_path(spark, "t_gate")
    # driver tickers look like 'U12' (digits), so the ticker regex expectation fails
    with pytest.raises(quality.QualityGateError):
        run_pipeline(g, "filings", root, gate=quality.SUITES)
    passing = {"sec_filings": [quality.Check("not_null", "filing_id")]}
    built = run_pipeline(g, "filings", root, gate=passing)
    assert built["mart_filing_dashboard"].count() > 0


def test_every_group_is_gated_by_all_its_tables(spark):
    import __spark_entry__ as E
    from helpers import SF_SMALL
    got = {(r.refresh_group, r.suites): r for r in E.queries()["pipeline_gate_groups"](spark, SF_SMALL).collect()}
    assert len(got) == 9
    for group in ("prices", "earnings", "filings"):
        assert got[group, "keys"].passed and got[group, "keys"].staged_rows > 0
        for suites in ("reference", "reference_texts"):          # the calls or the filings stop it
            assert not got[group, suites].passed and got[group, suites].staged_rows == 0


def test_csv_round_trip_with_quotes_commas_newlines(spark):
    from tidemark.session import scratch_path
    from tidemark.sources import files
    text = 'He said "growth, margin", then\nleft; ends with comma,'
    df = calls(spark, [{"call_id": "EC-1", "ticker": "AAPL", "call_date": D(2025, 1, 1), "speaker_role": "CEO",
                        "transcript_text": text, "confidence_score": 0.9,
                        "_loaded_at": dt.datetime(2025, 1, 2, 3, 4, 5)},
                       {"call_id": "EC-2", "ticker": "MSFT", "call_date": D(2025, 1, 2), "speaker_role": "CFO",
                        "transcript_text": "", "confidence_score": None}])
    path = scratch_path(spark, "t_csv")
    files.write_csv(df, path)
    back = files.load_csv(spark, path, schemas.EARNINGS_CALLS, multiLine="true")
    assert rows(back) == rows(df)
    filled = files.with_defaults(back, {"confidence_score": 0.85, "_loaded_at": "now"})
    got = {r.call_id: r for r in filled.collect()}
    assert got["EC-2"].confidence_score == 0.85 and got["EC-2"]._loaded_at is not None
    assert got["EC-1"]._loaded_at == dt.datetime(2025, 1, 2, 3, 4, 5)


def test_write_clustered_gives_disjoint_file_ranges(spark):
    from helpers import SF_SMALL
    from tidemark.session import scratch_path
    from tidemark.sources import adapters as ad, sinks
    bars = ad.DriverTables(spark, SF_SMALL).stock_prices
    path = scratch_path(spark, "t_cluster")
    sinks.write_clustered(bars, path, ["ticker", "price_date"], num_partitions=4)
    back = spark.read.parquet(path)
    assert rows(back, bars.columns) == rows(bars)
    ranges = sorted((r.lo, r.hi) for r in back.groupBy(F.input_file_name().alias("f"))
                    .agg(F.min(F.struct("ticker", "price_date")).alias("lo"),
                         F.max(F.struct("ticker", "price_date")).alias("hi")).collect())
    assert len(ranges) > 1
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))      # no overlap between files


def test_cdc_fingerprint_equals_struct_diff(spark):
    from helpers import SF_SMALL
    from tidemark.sources import adapters as ad
    A = _orders(spark, [(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (5, None, 5.0)])
    B = _orders(spark, [(1, "x", 1.0), (2, "y", 2.0), (4, "w", 4.0), (5, None, 5.0)])
    cols = ["k", "a", "b", "action", "is_update"]
    assert rows(cdc.cdc_changes_fingerprint(A, B, "k"), cols) == rows(cdc.cdc_changes(A, B, "k"), cols)
    calls_ = ad.DriverTables(spark, SF_SMALL).earnings_calls                 # wide text rows
    before = calls_.filter(F.col("call_date") < F.lit(D(2024, 1, 15)))
    after = calls_.withColumn("transcript_text", F.when(F.col("speaker_role") == "CEO",
                                                        F.concat("transcript_text", F.lit(" (rev)")))
                              .otherwise(F.col("transcript_text")))
    c1 = cdc.cdc_changes_fingerprint(before, after, "call_id")
    c2 = cdc.cdc_changes(before, after, "call_id")
    assert rows(c1, c2.columns) == rows(c2)


def test_hot_ticker_is_split_into_bounded_runs(spark):
    """A ticker with a third of all rows: every window partition of the
    spread plan stays within run_rows + one bucket + the halo."""
    n_hot, n_cold_tickers, per_cold = 30000, 200, 300          # hot = 1/3 of 90k rows
    start = D(1950, 1, 1)
    hot = spark.range(n_hot).select(F.lit("HOT").alias("ticker"),
                                    F.date_add(F.lit(start), F.col("id").cast("int")).alias("price_date"),
                                    (F.col("id") % 97 + 1).cast("double").alias("close_price"))
    cold = spark.range(n_cold_tickers * per_cold).select(
        F.concat(F.lit("C"), (F.col("id") % n_cold_tickers).cast("string")).alias("ticker"),
        F.date_add(F.lit(start), (F.col("id") / n_cold_tickers).cast("int")).alias("price_date"),
        (F.col("id") % 89 + 1).cast("double").alias("close_price"))
    df = hot.unionByName(cold).withColumn("price_id", F.concat("ticker", F.lit("-"), F.col("price_date").cast("string")))
    run_rows, halo = 4000, 49
    plan = indicators._run_plan(df, "ticker", "price_date", halo, run_rows, "month")
    sizes = (df.withColumn("_bucket", F.date_trunc("month", F.col("price_date").cast("timestamp_ntz")))
             .join(plan, ["ticker", "_bucket"], "left")
             .withColumn("_run", F.explode(F.coalesce("_runs", F.array(F.lit(0).cast("bigint")))))
             .groupBy("ticker", "_run").count())
    hot_parts = [r["count"] for r in sizes.filter(F.col("ticker") == "HOT").collect()]
    assert len(hot_parts) >= n_hot // run_rows                    # the hot ticker is spread out
    assert max(hot_parts) <= run_rows + 31 + halo + 31             # run + one month + halo months
    assert plan.select("ticker").distinct().count() == 1           # only the hot ticker is planned
    specs = [("ma", indicators.moving_avg(50))]
    plain = indicators.rolling(df, "ticker", "price_date", specs, 49, tie="price_id")
    spread = indicators.rolling(df, "ticker", "price_date", specs, 49, spread=True, tie="price_id",
                                run_rows=run_rows)
    cols = ["ticker", "price_date", "ma"]
    assert plain.select(cols).exceptAll(spread.select(cols)).count() == 0
    assert spread.count() == df.count()


def test_schema_drift_detects_each_change(spark):
    from tidemark.operators import monitor
    old = spark.createDataFrame([(1, "a", 1.0)], "id long, name string, score double")
    new = spark.createDataFrame([(1, 2, 3)], "id long, score int, extra int").withColumn("id", F.lit(1).cast("long"))
    drift = {r.column_name: r.change for r in monitor.schema_drift(
        monitor.schema_snapshot(new, "t"), monitor.schema_snapshot(old, "t")).collect()}
    assert drift == {"name": "REMOVED", "extra": "ADDED", "score": "TYPE_CHANGED", "id": "NULLABILITY_CHANGED"}


def test_upsert_reduces_copies_of_a_key(spark):
    target = _orders(spark, [(1, "x", 1.0)])
    copies = [(1, "c", float(i)) for i in range(50)] + [(7, "n", 7.0), (7, "n", 7.5)]
    ch = _orders(spark, copies).withColumn("action", F.lit("INSERT")).withColumn("seq", F.col("b"))
    out = {r.k: (r.a, r.b) for r in cdc.upsert(target, ch, "k", ["a", "b"], source_order="seq").collect()}
    assert out == {1: ("c", 49.0), 7: ("n", 7.5)}
    again = cdc.upsert(target, ch.drop("seq"), "k", ["a", "b"]).collect()
    assert sorted(r.k for r in again) == [1, 7]                  # one row per key, deterministic


def test_masks_with_per_row_role_column(spark):
    """A role column (e.g. from a session-to-role mapping) takes the CASE
    path; results equal folding each role at plan time."""
    roles = list(gov.ROLES)
    df = spark.createDataFrame([(r, "t" * 150, 0.3, [1.0] * 5, 44) for r in roles],
                               "role string, t string, s double, v array<double>, f bigint")
    per_row = df.select("role", gov.mask_transcript(F.col("t"), F.col("role")).alias("t"),
                        gov.mask_sentiment(F.col("s"), F.col("role")).alias("s"),
                        gov.mask_embedding(F.col("v"), F.col("role")).alias("v"),
                        gov.mask_file_size(F.col("f"), F.col("role")).alias("f"))
    folded = None
    for r in roles:
        part = df.filter(F.col("role") == r).select(
            "role", gov.mask_transcript(F.col("t"), r).alias("t"), gov.mask_sentiment(F.col("s"), r).alias("s"),
            gov.mask_embedding(F.col("v"), r).alias("v"), gov.mask_file_size(F.col("f"), r).alias("f"))
        folded = part if folded is None else folded.unionByName(part)
    assert rows(per_row) == rows(folded)


def test_alert_rules_fire_and_stay_quiet(spark):
    from tidemark.operators import alerts
    calls_ = spark.createDataFrame([(D(2024, 1, 1), 0.9), (D(2024, 1, 2), 0.95), (D(2024, 1, 3), None)],
                                   "call_date date, sentiment_score double")
    now_late, now_early = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 3, 3)
    rows_ = alerts.alerts([
        alerts.feed_stale({"calls": (calls_, "call_date")}, now_late),
        alerts.sentiment_mean(calls_),
        alerts.null_sentiment(calls_),
        alerts.new_ticker(spark.createDataFrame([("A",), ("B",)], "ticker string"),
                          spark.createDataFrame([("A",)], "ticker string")),
    ]).collect()
    got = {r.alert: (r.fired, r.measure) for r in rows_}
    assert got["alert_feed_stale"] == (True, 48.0)                 # 2024-01-03 00:00 -> 01-05 00:00
    assert got["alert_sentiment_mean"] == (True, 0.925)
    assert got["alert_null_sentiment"][0] is True and abs(got["alert_null_sentiment"][1] - 33.333333) < 1e-9
    assert got["alert_new_ticker"] == (True, 1.0)
    quiet = alerts.feed_stale({"calls": (calls_, "call_date")}, now_early).first()
    assert (quiet.fired, quiet.measure) == (False, 3.0)


def test_volume_trend_and_drop(spark):
    from tidemark.operators import monitor
    counts = [10, 10, 10, 10, 10, 10, 10, 2, 10]                     # a dip on day 8
    data = [(D(2024, 1, 1) + dt.timedelta(days=i),) for i, n in enumerate(counts) for _ in range(n)]
    df = spark.createDataFrame(data, "call_date date")
    trend = monitor.volume_trend(df, "call_date", D(2024, 1, 20))
    drop = monitor.volume_drop(trend, "call_date").collect()
    assert [r.call_date for r in drop] == [D(2024, 1, 8)]
    r = drop[0]
    assert r.daily_count == 2 and abs(r.rolling_7d_avg - 62 / 7) < 1e-12
    assert r.volume_pct_of_avg == round(2 / (62 / 7) * 100, 1)
