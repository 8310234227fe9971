"""The quality gate inside the write: one scan checks, counts and stages.

Every row-level check of a suite marks the rows that fail it. The marked rows
are written once, failing ones to a quarantine partition of their own with
the names of their checks, while ``observe`` counts what passes by, so the
gate costs no second scan of the raw table. Only a uniqueness check reads
something again: its key column, from what was just written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .quality import Check, QualityGateError, _lit, gate_rows

FAILED, CLEAN = "_failed", "_clean"
RESULTS = ("table_name string, check_index int, expectation string, column_name string, evaluated bigint, "
           "unexpected bigint, success boolean")


def breaks(df: DataFrame, c: Check) -> Column | None:
    """Does a row fail the check? None where only the table can; null for a missing value."""
    if c.kind in ("row_count", "unique"):
        return None
    x = F.col(c.column)
    if c.kind == "not_null":
        return x.isNull()
    if c.kind == "in_set":
        return ~x.isin(*c.values)
    if c.kind == "regex":
        return ~x.rlike(c.pattern)
    if c.kind == "between":
        return (x < _lit(df, c.column, c.lo)) | (x > _lit(df, c.column, c.hi))
    if c.kind == "length_between":
        return (F.length(x) < c.lo) | (F.length(x) > c.hi)
    raise ValueError(c.kind)


def label(i: int, c: Check) -> str:
    return f"{i}:{c.kind}" + (f":{c.column}" if c.column else "")


def marked(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """The rows with the labels of the checks that they fail."""
    names = [F.when(bad, F.lit(label(i, c))) for i, c in enumerate(suite) if (bad := breaks(df, c)) is not None]
    return df.withColumn(FAILED, F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


def metrics(suite: Sequence[Check]) -> list[Column]:
    """What ``observe`` counts on the marked rows: per check, evaluated and unexpected."""
    out = [F.count(F.lit(1)).alias("n"), F.count_if(F.size(FAILED) > 0).alias("failing")]
    for i, c in enumerate(suite):
        if c.kind in ("row_count", "unique"):
            continue
        out += [(F.count(F.lit(1)) if c.kind == "not_null" else F.count(c.column)).alias(f"e{i}"),
                F.count_if(F.array_contains(FAILED, label(i, c))).alias(f"u{i}")]
    return out


@dataclass
class Gated:
    """What a gated write left behind. ``results`` has a row per check."""

    clean: DataFrame
    quarantined: DataFrame
    results: DataFrame
    rows: int
    failing: int

    def passed(self, quarantine: bool) -> bool:
        """With ``quarantine`` rows that fail are set aside, and only checks of
        the whole table can stop it."""
        checks = self.results.filter(F.col("expectation").isin(*_TABLE_CHECKS)) if quarantine else self.results
        return not checks.filter(~F.col("success")).limit(1).count()


_TABLE_CHECKS = [Check(k).expectation for k in ("row_count", "unique")]


def _results(spark: SparkSession, table: str, suite: Sequence[Check], seen: dict, written: DataFrame) -> DataFrame:
    """The observed numbers (one row) as a row per check."""
    rows = []
    for i, c in enumerate(suite):
        if c.kind == "row_count":
            rows.append((table, i, c.expectation, None, seen["n"], None, int(c.lo) <= seen["n"] <= int(c.hi)))
        elif c.kind != "unique":
            rows.append((table, i, c.expectation, c.column, seen[f"e{i}"], seen[f"u{i}"], seen[f"u{i}"] == 0))
    parts = [spark.createDataFrame(rows, RESULTS)]
    for i, c in enumerate(suite):
        if c.kind == "unique":
            per_value = written.filter(F.col(c.column).isNotNull()).groupBy(c.column).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(per_value.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("evaluated"),
                F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("unexpected")).select(
                F.lit(table).alias("table_name"), F.lit(i).alias("check_index"), F.lit(c.expectation).alias("expectation"),
                F.lit(c.column).alias("column_name"), "evaluated", "unexpected", (F.col("unexpected") == 0).alias("success")))
    return reduce(DataFrame.unionByName, parts)


def write_gated(df: DataFrame, table: str, suite: Sequence[Check], path: str) -> Gated:
    """Write ``df`` below ``path`` in one pass, rows that fail a row-level
    check apart, and say how the suite went."""
    spark, counted = df.sparkSession, Observation()
    rows = marked(df, suite).observe(counted, *metrics(suite)).withColumn(CLEAN, F.size(FAILED) == 0)
    rows.write.option("compression", "zstd").partitionBy(CLEAN).parquet(path)
    seen = counted.get
    written = spark.read.schema(rows.schema).parquet(path)
    return Gated(written.filter(CLEAN).select(*df.columns), written.filter(~F.col(CLEAN)).drop(CLEAN),
                 _results(spark, table, suite, seen, written), seen["n"], seen["failing"])


def gate_all(tables: dict[str, DataFrame], suites: dict[str, list[Check]], root: str, quarantine: bool = False) -> dict[str, Gated]:
    """Gated writes of all tables that have a suite; raises ``QualityGateError``
    if one of them does not pass. What was written stays for inspection."""
    done = {name: write_gated(df, name, suites[name], f"{root}/{name}") for name, df in tables.items() if name in suites}
    failed = [name for name, g in done.items() if not g.passed(quarantine)]
    if failed:
        counts = reduce(DataFrame.unionByName, [gate_rows(done[n].results) for n in failed]).collect()      # a row per table
        raise QualityGateError(", ".join(f"{r.table_name}: {r.failed_checks} failed" for r in counts))
    return done


def gated_stream(stream: DataFrame, table: str, suite: Sequence[Check], target: str, checkpoint: str,
                 trigger: dict | None = None, lag: str = "1 minute") -> StreamingQuery:
    """The same gate per micro-batch: marked rows to ``target/rows``, the checks
    of each batch to ``target/checks``, in a folder of their batch, so a replay
    replaces them. Uniqueness and row counts are those of the batch."""
    spark = stream.sparkSession

    def body(batch: DataFrame, batch_id: int) -> None:
        counted = Observation()
        rows = marked(batch, suite).observe(counted, *metrics(suite)).withColumn(CLEAN, F.size(FAILED) == 0)
        part = f"batch={batch_id}"
        rows.write.mode("overwrite").partitionBy(CLEAN).parquet(f"{target}/rows/{part}")
        written = spark.read.schema(rows.schema).parquet(f"{target}/rows/{part}")
        _results(spark, table, suite, counted.get, written).write.mode("overwrite").parquet(f"{target}/checks/{part}")

    return (stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": lag})).start())


def read_gated_stream(spark: SparkSession, target: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean rows, quarantined rows with their failed checks, checks per batch) so far."""
    rows = spark.read.parquet(f"{target}/rows").withColumn(CLEAN, F.col(CLEAN).cast("boolean"))
    return (rows.filter(CLEAN).select(*columns), rows.filter(~F.col(CLEAN)).select(*columns, FAILED, "batch"),
            spark.read.parquet(f"{target}/checks"))
