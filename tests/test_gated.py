"""The gate inside the write, mergeable profiles, and bucket digests."""

import datetime as dt
import os
from glob import glob

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import SF_SMALL, rows
from pyspark.sql import functions as F

from tidemark.functions.rules import FIXTURE
from tidemark.operators import cdc, gated, profiles, quality, staging
from tidemark.operators.quality import Check
from tidemark.plans.graph import graph_from_driver
from tidemark.plans.pipeline import group_models, run_pipeline
from tidemark.session import ensure_checkpoint_dir, scratch_path
from tidemark.sources import adapters as ad

SUITE = [Check("not_null", "k"), Check("unique", "k"), Check("regex", "t", pattern="^[A-Z]{1,5}$"), Check("between", "p", 0.0, 10.0),
         Check("length_between", "t", 1, 5), Check("in_set", "t", values=("A", "BB", "bad")), Check("row_count", None, 1, 100)]
SCHEMA = "k long, t string, p double, d date"
DAY = dt.date(2024, 1, 1)
ROWS = [(1, "A", 1.0, DAY), (2, "BB", None, DAY), (None, "A", 2.0, None), (3, "bad", 3.0, DAY), (4, None, 11.0, DAY), (4, "A", 5.0, DAY),
        (5, "TOOLONG", 5.0, DAY)]


def test_write_splits_rows_and_counts_like_a_scan(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    g = gated.write_gated(df, "t", SUITE, scratch_path(spark, "gate"))
    assert (g.rows, g.failing) == (7, 4)
    assert rows(g.results) == rows(quality.validate(df, "t", SUITE))
    assert rows(g.clean) == rows(df.filter("k in (1, 2) or (k = 4 and t = 'A')"))
    failed = {(r["k"], r["t"]): r["_failed"] for r in g.quarantined.collect()}
    assert failed[None, "A"] == ["0:not_null:k"] and failed[3, "bad"] == ["2:regex:t"] and failed[4, None] == ["3:between:p"]
    assert failed[5, "TOOLONG"] == ["2:regex:t", "4:length_between:t", "5:in_set:t"]
    assert not g.passed(quarantine=False) and not g.passed(quarantine=True)          # k is not unique


def test_quarantine_sets_rows_aside(spark):
    df = spark.createDataFrame(ROWS[:5], SCHEMA)
    root = scratch_path(spark, "gate")
    with pytest.raises(quality.QualityGateError, match="t: 3 failed"):
        gated.gate_all({"t": df}, {"t": SUITE}, f"{root}/a")
    done = gated.gate_all({"t": df}, {"t": SUITE}, f"{root}/b", quarantine=True)["t"]
    assert done.clean.count() == 2 and done.quarantined.count() == 3
    empty = gated.write_gated(df.limit(0), "t", SUITE, f"{root}/c")
    assert empty.rows == 0 and rows(empty.results) == rows(quality.validate(df.limit(0), "t", SUITE))


def test_gate_costs_one_scan_of_the_raw_table(spark):
    """Rows that a counting source gives out: once per row, gate included."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(ROWS, SCHEMA).mapInArrow(count, SCHEMA)
    g = gated.write_gated(df, "t", SUITE, scratch_path(spark, "gate"))
    g.results.collect(), g.clean.count()
    assert seen.value == len(ROWS)


def test_refresh_group_behind_the_gate(spark):
    graph = graph_from_driver(spark, SF_SMALL, FIXTURE)
    root = scratch_path(spark, "run")
    with pytest.raises(quality.QualityGateError):
        run_pipeline(graph, "earnings", f"{root}/a")
    suites = {"earnings_calls": [Check("not_null", "confidence_score"), Check("unique", "call_id")], "stock_prices": [Check("not_null", "price_id")]}
    built = run_pipeline(graph, "earnings", f"{root}/b", gate=suites, quarantine=True)
    raw = ad.DriverTables(spark, SF_SMALL).earnings_calls
    staged = lambda df: staging.stg_earnings_calls(df, ad.AS_OF).count()
    assert built["stg_earnings_calls"].count() == staged(raw.filter("confidence_score is not null")) < staged(raw)


def test_gated_stream_counts_every_batch(spark):
    root = scratch_path(spark, "gate_stream")
    for i, part in enumerate((ROWS[:4], ROWS[4:])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{root}/feed/d{i}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/feed/*")
        gated.gated_stream(stream, "t", SUITE, f"{root}/out", f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    clean, held, checks = gated.read_gated_stream(spark, f"{root}/out", ["k", "t", "p", "d"])
    assert clean.count() == 3 and held.count() == 4
    assert checks.groupBy("batch").count().count() == 2
    assert checks.filter("check_index = 0").agg(F.sum("unexpected")).first()[0] == 1


# ------------------------------------------------------------------ profiles
def test_merged_profile_within_stated_errors(spark):
    rng = np.random.default_rng(1)
    n = 20_000
    rows_ = [(int(i), float(x), f"s{int(x * 3) % 700}", DAY + dt.timedelta(days=int(i) % 90), None if i % 10 else True)
             for i, x in enumerate(rng.lognormal(3, 1, n))]
    df = spark.createDataFrame(rows_, "i long, x double, s string, d date, b boolean")
    parts = [df.filter("i < 6000"), df.filter("i >= 6000 and i < 6100"), df.filter("i >= 6100"), df.limit(0)]
    kept = scratch_path(spark, "profiles")
    for k, p in enumerate(parts):
        profiles.profile_sketches(p, f"load{k}").write.mode("append").parquet(kept)
    merged = {r["column_name"]: r for r in profiles.estimates(profiles.merge_profiles(spark.read.parquet(kept))).collect()}
    exact = {r["column_name"]: r for r in quality.profile(df, exact=True).collect()}
    for c in df.columns:
        m, e = merged[c], exact[c]
        assert (m["non_null_count"], m["null_count"], m["min_value"], m["max_value"]) == (
            e["non_null_count"], e["null_count"], e["min_value"], e["max_value"])
        assert abs(m["distinct_estimate"] - e["distinct_count"]) <= 0.05 * e["distinct_count"]
        for name in ("mean_value", "stddev_value"):
            assert m[name] == pytest.approx(e[name], rel=1e-6, abs=1e-6)
    x = np.sort([r[1] for r in rows_])
    for q in (25, 50, 75):
        assert abs(np.searchsorted(x, merged["x"][f"q{q}"]) / n - q / 100) < 0.03
    plan = profiles.profile_sketches(df, "one")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


# ------------------------------------------------------------------- digests
def test_digests_find_the_changed_buckets(spark):
    before, after = ad.DriverTables(spark, SF_SMALL).cdc_pair()
    assert rows(cdc.cdc_changes_by_digest(before, after, "o_orderkey", 64)) == rows(cdc.cdc_changes(before, after, "o_orderkey"))
    assert cdc.cdc_changes_by_digest(after, after, "o_orderkey").count() == 0
    # a value that moves to another column, nulls, an added and a lost copy
    a = spark.createDataFrame([(1, None, 5), (2, 7, None), (3, 1, 1), (4, 0, 0)], "k long, x long, y long")
    b = spark.createDataFrame([(1, 5, None), (2, 7, None), (3, 1, 1), (5, 0, 0)], "k long, x long, y long")
    assert rows(cdc.cdc_changes_by_digest(a, b, "k", 4)) == rows(cdc.cdc_changes(a, b, "k"))
    assert {r["stream_name"]: r["has_data"] for r in cdc.has_data({"same": (a, a.orderBy(F.desc("k"))), "moved": (a, b),
                                                                  "copy": (a, a.union(a.limit(1))), "none": (a.limit(0), a.limit(0))}).collect()} == {
        "same": False, "moved": True, "copy": True, "none": False}


def test_small_second_load_reads_few_partitions(spark):
    before, _ = ad.DriverTables(spark, SF_SMALL).cdc_pair()
    two = [r[0] for r in before.select("o_orderkey").limit(2).collect()]
    after = before.withColumn("o_totalprice", F.when(F.col("o_orderkey").isin(two), 0.5).otherwise(F.col("o_totalprice")))
    root = scratch_path(spark, "stored")
    for name, df in (("a", before), ("b", after)):
        cdc.store_version(df, f"{root}/{name}", "o_orderkey", buckets=32)
    got = cdc.stored_changes(spark, f"{root}/a", f"{root}/b", "o_orderkey", before.schema)
    assert rows(got) == rows(cdc.cdc_changes(before, after, "o_orderkey"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan
    touched = got.select(F.pmod(F.xxhash64("o_orderkey"), F.lit(32))).distinct().count()
    assert touched <= 2


# ------------------------------------------------------------- refresh groups
GROUP_MART = {"refresh_group": "mart_research_signals", "refresh_group_earnings": "mart_earnings_summary", "refresh_group_ml": "ml_sentiment_training"}


def group_tables(spark, low):
    """Driver tables with user ids of one to six digits and ``low`` as the lowest value."""
    root = scratch_path(spark, "group_tables")
    ts = [dt.datetime(2024, 1, 1 + i, 12) for i in range(25)]
    tables = {"events": ([(i * 10 + k, t, u, "view", low if i == 24 else 5.0 + (i * 7 + k) % 11) for k, u in enumerate((2, 14, 1000, 123456))
                          for i, t in enumerate(ts)], "event_id long, ts timestamp, user_id long, event_type string, value double"),
              "conversations": ([(c, n, r, f"Revenue growth was strong in quarter {c}. We see risk.") for c in (2, 14, 17)
                                 for n, r in enumerate(("user", "assistant"))], "conv_id long, turn int, role string, text string"),
              "documents": ([(d, f"Risk of litigation and loss, item {d}.", "en", "web", 40) for d in (1, 7, 76)],
                            "doc_id long, text string, lang string, source string, n_chars long")}
    for name, (given, schema) in tables.items():
        spark.createDataFrame(given, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("query", GROUP_MART)
def test_refresh_group_takes_every_user_and_price(spark, query):
    import __spark_entry__ as E
    root = group_tables(spark, 0.0)
    got, want = E.queries()[query](spark, root), graph_from_driver(spark, root, FIXTURE).get(GROUP_MART[query])
    want = E._counts_as_double(want) if query == "refresh_group" else want
    assert want.count() and rows(got, want.columns) == rows(want)
    if query == "refresh_group":
        assert {r.ticker for r in got.collect()} == {"U2", "U14", "U1000", "U123456"}
    with pytest.raises(quality.QualityGateError, match="stock_prices"):          # the gate still stops a price below zero
        E.queries()[query](spark, group_tables(spark, -0.01))


def test_gated_runs_do_not_add_up_on_disk(spark, monkeypatch):
    """Nine whole runs, each with the tables of no other run beside its own, texts in zstd."""
    import __spark_entry__ as E
    given, base, held, codecs = group_tables(spark, 5.0), ensure_checkpoint_dir(spark), [], set()
    runs = lambda: sorted(x for x in os.listdir(base) if x.startswith("gated-"))
    before = runs()

    def run(graph, group, root, **options):
        held.append(runs())
        try:
            built = run_pipeline(graph, group, root, **options)
            assert set(built) == set(group_models(group)) and all(df.count() >= 0 for df in built.values())
            return built
        finally:
            files = glob(f"{root}/**/*.parquet", recursive=True)
            assert files                          # what a run wrote is there until its figures are taken
            codecs.update(pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).num_row_groups)

    monkeypatch.setattr(E, "run_pipeline", run)
    got = {(r.refresh_group, r.suites): (r.passed, r.staged_rows) for r in E.queries()["pipeline_gate_groups"](spark, given).collect()}
    staged = {"prices": 100, "earnings": 6, "filings": 3}
    assert got == {(g, s): (s == "keys", n if s == "keys" else 0) for g, n in staged.items() for s in ("reference", "keys", "reference_texts")}
    assert held == [before] * 9 and runs() == before
    assert codecs == {"ZSTD"}
