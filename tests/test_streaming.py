"""Structured Streaming jobs: two file drops with availableNow, equality
with the batch result, and idempotent re-runs on the same checkpoint."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from tidemark.operators import cdc, indicators, staging
from tidemark.session import scratch_path
from tidemark.sources import adapters as ad
from tidemark.streaming import cdc_stream, refresh
from tidemark.streaming.store import PartitionedTable, VersionedTable


def test_cdc_stream_equals_batch_and_is_idempotent(spark):
    t = ad.DriverTables(spark, SF_SMALL)
    before, after = t.cdc_pair()
    changes = cdc.cdc_changes(before, after, "o_orderkey")
    root = scratch_path(spark, "t_cdc")
    target, src, ckpt, log = f"{root}/target", f"{root}/src", f"{root}/ckpt", f"{root}/log"
    store = VersionedTable(spark, target)
    store.write(before, 0)
    upd = ["o_orderstatus", "o_totalprice"]
    drops = [changes.filter(~F.col("is_update")), changes.filter(F.col("is_update"))]
    for i, d in enumerate(drops):
        d.write.parquet(f"{src}/drop{i}")
        cdc_stream.run_cdc_stream(spark, f"{src}/*", drops[0].schema, store, "o_orderkey", upd, ckpt,
                                  trigger={"availableNow": True}, log_path=log).awaitTermination()
    versions = store.versions()
    batch = cdc.upsert(before, changes, "o_orderkey", upd)
    assert rows(store.read()) == rows(batch)
    # same checkpoint, no new files: nothing processed, no new version
    cdc_stream.run_cdc_stream(spark, f"{src}/*", drops[0].schema, store, "o_orderkey", upd, ckpt,
                              trigger={"availableNow": True}, log_path=log).awaitTermination()
    assert store.versions() == versions
    logged = spark.read.parquet(log)
    assert logged.filter(F.col("event_type") == "EARNINGS_PROCESSED").count() == len(versions) - 1
    # a replayed batch id finds its version committed and is skipped
    body = cdc_stream.cdc_batch_body(spark, store, "o_orderkey", upd)
    body(drops[1], 0)
    assert store.versions() == versions


def test_refresh_stream_recomputes_affected_tickers(spark):
    bars = ad.DriverTables(spark, SF_SMALL).stock_prices
    as_of, now = ad.AS_OF, ad.NOW
    root = scratch_path(spark, "t_refresh")

    def body(raw):            # production body: affected tickers' last 50 bars only
        return indicators.dt_price_summary_from_bars(staging.stg_stock_prices(raw, as_of), now)

    def batch(raw):           # the model definition: all bars windowed
        return indicators.dt_price_summary(indicators.int_price_metrics(staging.stg_stock_prices(raw, as_of)), now)

    cut = F.lit(dt.date(2024, 1, 20))
    for i, d in enumerate([bars.filter(F.col("price_date") < cut), bars.filter(F.col("price_date") >= cut)]):
        d.write.parquet(f"{root}/base/d{i}")
        refresh.refresh_stream(spark, body, f"{root}/base/*", bars.schema, f"{root}/target", ["ticker"],
                               f"{root}/ckpt", trigger={"availableNow": True}).awaitTermination()
    got = VersionedTable(spark, f"{root}/target").read()
    assert rows(got) == rows(batch(bars))


def files_of(spark, path):
    """partition/file -> path of a written table."""
    return {"/".join(r["f"].rsplit("/", 2)[1:]): r["f"] for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}


def test_change_stream_rewrites_only_touched_partitions(spark):
    t = ad.DriverTables(spark, SF_SMALL)
    before, after = t.cdc_pair()
    changes = cdc.cdc_changes(before, after, "o_orderkey")
    root = scratch_path(spark, "t_partitioned")
    store = PartitionedTable(spark, f"{root}/target", key="o_orderkey", buckets=16)
    store.create(before)
    upd = ["o_orderstatus", "o_totalprice"]

    def run():
        cdc_stream.run_cdc_stream(spark, f"{root}/src/*", changes.schema, store, "o_orderkey", upd, f"{root}/ckpt",
                                  trigger={"availableNow": True}, table_schema=before.schema).awaitTermination()

    # one change row only: a single partition is rewritten
    old = files_of(spark, store.path)
    one = changes.filter(F.col("action") == "INSERT").orderBy("o_orderkey").limit(1)
    one.write.parquet(f"{root}/src/d0")
    run()
    new = files_of(spark, store.path)
    assert len({f.rsplit("/", 2)[1] for n, f in new.items() if n not in old}) == 1
    assert len(old.keys() - new.keys()) == 1
    assert rows(store.read(before.schema)) == rows(cdc.upsert(before, one, "o_orderkey", upd))
    # the remaining changes arrive: same result as the batch upsert
    changes.write.parquet(f"{root}/src/d1")
    run()
    want = rows(cdc.upsert(before, changes, "o_orderkey", upd))
    assert rows(store.read(before.schema)) == want
    # a batch that failed after its commit is only put into the table again
    cdc_stream.cdc_batch_body(spark, store, "o_orderkey", upd, schema=before.schema)(changes.limit(0), 1)
    assert rows(store.read(before.schema)) == want


def test_partition_refresh_rewrites_only_its_days(spark):
    from tidemark.functions.rules import FIXTURE
    from tidemark.operators import enrich
    from tidemark.plans.graph import dt_filing_risk_signals
    filings = ad.DriverTables(spark, SF_SMALL).sec_filings
    root = scratch_path(spark, "t_days")

    def body(raw):
        return dt_filing_risk_signals(enrich.int_filing_classifications(staging.stg_sec_filings(raw, ad.AS_OF), FIXTURE), ad.NOW)

    def run(drop, i):
        drop.write.parquet(f"{root}/base/d{i}")
        refresh.refresh_stream(spark, body, f"{root}/base/*", filings.schema, f"{root}/target", ["filing_date"], f"{root}/ckpt",
                               trigger={"availableNow": True}, by_partition=True).awaitTermination()

    day = filings.agg(F.max("filing_date")).first()[0]
    run(filings.filter((F.col("filing_date") < day) | (F.col("ticker") > "U5")), 0)
    old = files_of(spark, f"{root}/target/table")
    run(filings.filter((F.col("filing_date") == day) & ~(F.col("ticker") > "U5")), 1)
    new = files_of(spark, f"{root}/target/table")
    assert {f.rsplit("/", 2)[1] for n, f in new.items() if n not in old} == {f"filing_date={day}"}
    want = body(filings)
    assert rows(PartitionedTable(spark, f"{root}/target", ["filing_date"]).read(want.schema)) == rows(want)


def test_keyed_state_stream_over_drops_restart_and_late_bars(spark):
    """Several drops, each a new query on the same checkpoint: late bars, bars
    that replace theirs, and a ticker whose last closes are all missing."""
    schema = "price_id string, ticker string, price_date date, open_price double, high_price double, low_price double, close_price double, volume long"
    days = [dt.date(2023, 1, 2) + dt.timedelta(days=i) for i in range(130)]
    bars = [(f"{k}-{i}", k, d, 1.0, 1.0, 1.0, None if k == "NUL" and i >= 70 else 10.0 + i % 7 + len(k), 100 + i)
            for k in ("AA", "BBB", "NUL") for i, d in enumerate(days)]
    late = [b for b in bars if b[1] == "AA" and 100 <= bars.index(b) < 110]
    wrong = [(*b[:6], 999.0, b[7]) for b in bars if b[1] == "BBB"][-3:]
    right = [b for b in bars if b[1] == "BBB"][-3:]
    rest = [b for b in bars if b not in late and b not in right]
    drops = [rest[:200] + wrong, rest[200:], late, right]
    root = scratch_path(spark, "t_state")

    def metrics(b):
        b = b.withColumn("daily_return_pct", F.lit(0.1) * F.col("volume")).withColumn("dollar_volume", F.col("close_price") * F.col("volume"))
        return indicators.dt_price_summary(indicators.int_price_metrics(b), ad.NOW)

    for i, drop in enumerate(drops):
        spark.createDataFrame(drop, schema).write.parquet(f"{root}/base/d{i}")
        stream = spark.readStream.schema(schema).parquet(f"{root}/base/*")
        q = refresh.last_bars_stream(spark, stream, metrics, f"{root}/target", f"{root}/ckpt", trigger={"availableNow": True})
        q.awaitTermination()
        assert q.lastProgress["numInputRows"] == len(drop)          # no old bars are read
    want = metrics(spark.createDataFrame(bars, schema))
    got = PartitionedTable(spark, f"{root}/target", ["ticker"]).read(want.schema)
    assert rows(got) == rows(want) and got.count() == 3


def test_event_log_idempotent_and_progress_monitor(spark):
    from tidemark.operators import monitor
    from tidemark.sources import sinks
    from tidemark.streaming.progress import progress_log
    root = scratch_path(spark, "t_log")
    for _ in range(2):                                   # a replayed batch logs once
        sinks.log_event(spark, f"{root}/log", "EARNINGS_CDC", {"batch_id": 0}, 5, key="b0-EARNINGS_CDC")
    sinks.log_event(spark, f"{root}/log", "EARNINGS_PROCESSED", {"batch_id": 0}, 5, key="b0-EARNINGS_PROCESSED")
    log = sinks.read_event_log(spark, f"{root}/log")
    assert log.count() == 2 and set(log.columns) == {"event_id", "event_type", "event_time", "details",
                                                      "records_affected"}
    bars = ad.DriverTables(spark, SF_SMALL).stock_prices
    bars.write.parquet(f"{root}/base")
    q = refresh.append_stream(spark, lambda df: df.select("ticker", "price_date"), f"{root}/base",
                              bars.schema, f"{root}/out", f"{root}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    prog = progress_log(spark, {"dt_price_summary": q})
    health = monitor.refresh_health(prog, dt.datetime(2100, 1, 1), {"dt_price_summary": "1 minute"}).collect()
    assert len(health) == 1 and health[0].state == "SUCCEEDED" and health[0].target_lag == "1 minute"
    assert health[0].minutes_since_refresh > 0


def test_restrict_to_keys_keeps_null_keys(spark):
    from tidemark.streaming.refresh import restrict_to_keys
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    affected = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert rows(restrict_to_keys(df, affected, ["k"])) == [("a", 1), (None, 2)]


def test_refresh_replaces_null_keys(spark):
    root = scratch_path(spark, "t_null")
    store = VersionedTable(spark, f"{root}/target")
    schema = "k string, v int"
    total = lambda df: df.groupBy("k").agg(F.sum("v").alias("v"))
    for i, drop in enumerate([[("a", 1), (None, 2)], [(None, 5)]]):
        batch = spark.createDataFrame(drop, schema)
        batch.write.mode("append").parquet(f"{root}/base")
        refresh.refresh_batch_body(spark, total, f"{root}/base", batch.schema, store, ["k"])(batch, i)
    assert rows(store.read()) == [("a", 1), (None, 7)]


def test_event_log_keeps_rows_with_and_without_key(spark):
    from tidemark.sources import sinks
    target = f"{scratch_path(spark, 't_log')}/log"
    sinks.log_event(spark, target, "PLAIN", None)
    sinks.log_event(spark, target, "KEYED", {"a": 1}, 3, key="b0")
    sinks.log_event(spark, target, "PLAIN", None)
    assert sorted(r.event_type for r in sinks.read_event_log(spark, target).collect()) == ["KEYED", "PLAIN", "PLAIN"]


def test_restrict_to_keys_composite_key_uses_semi_join(spark):
    from tidemark.streaming.refresh import restrict_to_keys
    filings = ad.DriverTables(spark, SF_SMALL).sec_filings
    affected = filings.select("ticker", "filing_date").distinct().orderBy("ticker", "filing_date").limit(5)
    got = restrict_to_keys(filings, affected, ["ticker", "filing_date"])
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()
    cols = filings.columns
    assert got.columns == cols
    assert rows(got, cols) == rows(filings.join(affected, ["ticker", "filing_date"], "left_semi"), cols)


@pytest.mark.parametrize("query", ["dt_price_summary_stream", "dt_price_summary_refresh"])
def test_price_summary_folders_do_not_grow_with_tickers(spark, query):
    """150 tickers, some of them in one drop only: folders are those of the buckets."""
    import __spark_entry__ as E
    root = scratch_path(spark, "t_tickers")
    events = [(u * 100 + d, dt.datetime(2024, 1, d, 12), u, "view", float((u * d) % 13))
              for u in range(150) for d in ((3, 5), (4, 25), (22, 28))[u % 3]]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{root}/events.parquet")
    got = E.queries()[query](spark, root)
    want = E.G(spark, root).get("dt_price_summary")
    assert rows(got) == rows(want) and got.count() == 150
    assert len({f.rsplit("/", 2)[1] for f in got.inputFiles()}) <= 64


def test_replace_keys_keeps_the_bucket_rows_of_other_keys(spark):
    schema = "k string, v int"
    root = scratch_path(spark, "t_keys")
    store = PartitionedTable(spark, f"{root}/target", key="k", buckets=2)
    first = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5)], schema)
    second = spark.createDataFrame([("b", 20), (None, 40), ("d", 60)], schema)
    want = rows(spark.createDataFrame([("a", 1), ("b", 20), (None, 40), ("c", 5), ("d", 60)], schema))
    assert store.replace_keys(first, 1) and rows(store.read(first.schema)) == rows(first)
    store.fresh.write(second, 2)                          # the batch failed after its rows were computed
    assert store.replace_keys(second.limit(0), 2) and rows(store.read(first.schema)) == want
    assert not store.replace_keys(second.limit(0), 2)     # and again after its commit
    assert rows(store.read(first.schema)) == want
    assert store.replace_keys(second.limit(0), 3) and rows(store.read(first.schema)) == want
