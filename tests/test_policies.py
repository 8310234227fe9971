"""Policies as SQL against the DataFrame forms; lookups; the run log."""

import datetime as dt

from helpers import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.operators import governance as gov
from tidemark.operators import monitor, policies_sql
from tidemark.session import scratch_path
from tidemark.sources import adapters as ad
from tidemark.sources import sinks
from tidemark.streaming import progress

SIGNALS = [("AAPL", 0.7), ("TSLA", -0.7), ("XOM", None), (None, 0.2)]


def test_views_follow_the_role_variable(spark):
    df = spark.createDataFrame(SIGNALS, "ticker string, ceo_sentiment double")
    policies_sql.install(spark)
    policies_sql.create_views(spark, {"mart_research_signals": df})
    for role in gov.ROLES:
        policies_sql.set_role(spark, role)
        got = spark.sql("SELECT * FROM secure_mart_research_signals")
        assert rows(got) == rows(gov.secure_view(df, "mart_research_signals", role)), role
        assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_every_mask_as_sql(spark):
    texts = spark.createDataFrame([("x" * 300, 1.0, [1.0] * 5, 17), (None, None, None, None), ("ab", -0.2, [0.5] * 5, 4)],
                                  "t string, s double, v array<double>, k bigint")
    policies_sql.install(spark)
    texts.createOrReplaceTempView("masked_values")
    for role in gov.ROLES:
        got = spark.sql(f"SELECT mask_transcript(t, '{role}') AS t, mask_sentiment(s, '{role}') AS s, mask_embedding(v, '{role}') AS v, "
                        f"mask_file_size(k, '{role}') AS k FROM masked_values")
        want = texts.select(gov.mask_transcript("t", role).alias("t"), gov.mask_sentiment("s", role).alias("s"),
                            gov.mask_embedding("v", role).alias("v"), gov.mask_file_size("k", role).alias("k"))
        assert rows(got) == rows(want), role


def test_roles_from_one_derivation(spark):
    df = spark.createDataFrame(SIGNALS, "ticker string, ceo_sentiment double")
    got = gov.secure_view_roles(df, "mart_research_signals")
    for role in gov.ROLES:
        assert rows(got.filter(F.col("role") == role).drop("role")) == rows(gov.secure_view(df, "mart_research_signals", role)), role
    assert rows(gov.per_role(df, ["PUBLIC"], col="ticker")) == []


def test_lookup_reads_few_row_groups(spark):
    import glob

    import pyarrow.parquet as pq
    filings = ad.DriverTables(spark, "/root/testdata/sf0.01").sec_filings
    target = scratch_path(spark, "lookup")
    filings.coalesce(1).sortWithinPartitions("ticker").write.option("parquet.block.size", 4096).option(
        "parquet.bloom.filter.enabled#ticker", "true").parquet(target)
    keys = filings.select("ticker").orderBy("ticker").limit(1)
    got = sinks.lookup(spark, target, "ticker", keys, filings.schema)
    key = keys.first()[0]
    assert rows(got) == rows(filings.filter(F.col("ticker") == key))
    assert f"In(ticker, [{key}])" in got._jdf.queryExecution().executedPlan().toString() or "EqualTo(ticker" in got._jdf.queryExecution().executedPlan().toString()
    stats = [pq.ParquetFile(f).metadata for f in glob.glob(target.removeprefix("file:") + "/*.parquet")]
    groups = [m.row_group(i).column(1).statistics for m in stats for i in range(m.num_row_groups)]
    assert len(groups) > 3
    assert sum(g.min <= key <= g.max for g in groups) <= 2              # the others are skipped by their statistics


def test_lookup_of_many_keys_joins(spark, monkeypatch):
    monkeypatch.setattr(sinks, "LOOKUP_VALUES", 3)
    df = spark.range(100).selectExpr("id", "id * 2 as v")
    target = scratch_path(spark, "lookup")
    sinks.write_with_bloom(df, target, ["id"])
    keys = spark.createDataFrame([(i,) for i in (1, 5, 5, 7, 50, 999, None)], "k long")
    got = sinks.lookup(spark, target, "id", keys)
    assert rows(got, ["id"]) == [(1,), (5,), (50,), (7,)]
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sinks.lookup(spark, target, "id", keys.limit(0)).count() == 0


def test_run_log_keeps_every_batch_and_failure(spark):
    root = scratch_path(spark, "runs")
    schema = "id long"

    def broken(batch, batch_id):
        raise ValueError("no header in feed 7")

    def run(name, drop, body=None):
        spark.range(drop, drop + 5).toDF("id").write.parquet(f"{root}/{name}/in/d{drop}")
        w = (spark.readStream.schema(schema).parquet(f"{root}/{name}/in/*").writeStream.queryName(name)
             .option("checkpointLocation", f"{root}/{name}/ckpt").trigger(availableNow=True))
        w = w.foreachBatch(body) if body else w.format("parquet").option("path", f"{root}/{name}/out")
        w.start().awaitTermination()

    with progress.RunLog(spark, f"{root}/log"):
        for drop in range(3):
            run("steady", 10 * drop)
        try:
            run("broken", 0, broken)
            raise AssertionError
        except StreamingQueryException:
            pass
    log = progress.read_runs(spark, f"{root}/log")
    steady = log.filter("name = 'steady' and input_rows > 0").orderBy("batch_id").collect()
    assert [r["batch_id"] for r in steady] == [0, 1, 2] and [r["refresh_reason"] for r in steady] == ["INITIAL", "NEW_DATA", "NEW_DATA"]
    assert all(r["input_rows"] == 5 and r["state"] == "SUCCEEDED" for r in steady)
    failed = log.filter("state = 'FAILED'").collect()
    assert len(failed) == 1 and failed[0]["name"] == "broken" and failed[0]["error_code"] and failed[0]["completed_time"] is not None
    assert "no header in feed 7" in failed[0]["error_message"]
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None) + dt.timedelta(minutes=5)
    jobs = {r["task_name"]: r for r in monitor.job_summary(log, now).collect()}
    assert jobs["broken"]["failed_runs"] == 1 and jobs["steady"]["failed_runs"] == 0 and jobs["steady"]["input_rows"] == 15
    assert monitor.job_summary(log, now + dt.timedelta(days=8)).count() == 0
    # another log on the same session hears only what happens after it
    with progress.RunLog(spark, f"{root}/log2"):
        run("steady", 100)
    assert progress.read_runs(spark, f"{root}/log2").select("name").distinct().collect()[0][0] == "steady"
