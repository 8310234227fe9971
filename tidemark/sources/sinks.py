"""Sinks: append, materialize (view / table / inline), clustered and
point-lookup layouts, and the audit event log.

Tables are Parquet directories in a shared folder. Writes go through
Spark's commit protocol (task output is committed only when the task
succeeds), so a lost executor causes a retried task, never a partial file.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def append(df: DataFrame, target: str) -> None:
    """INSERT INTO target SELECT ... (append to a Parquet table)."""
    df.write.mode("append").parquet(target)


def materialize(df: DataFrame, name: str, kind: str = "table", layer: str | None = None,
                root: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Persist a model.

    * ``view``: a temp view over the lazy plan (recomputed per use);
    * ``table``: written to ``root/layer/name`` (optionally partitioned by
      ``partition_by``; in zstd, as every text model holds the texts again)
      and re-read, which cuts the lineage (the written table survives lost
      executors);
    * ``inline``: the DataFrame itself (ephemeral model).
    """
    if kind == "inline":
        return df
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"unknown materialization {kind!r}")
    if root is None:
        raise ValueError("a table needs a root folder")
    path = f"{root.rstrip('/')}/{layer or 'staging'}/{name}"
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:                      # e.g. a date column: later date filters prune folders
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def write_clustered(df: DataFrame, target: str, keys: Sequence[str],
                    num_partitions: int | None = None) -> None:
    """Range-cluster by keys (e.g. ticker, price_date).

    ``repartitionByRange`` samples key boundaries, so each output file
    covers a contiguous key range; sorting within partitions gives tight
    row-group min/max statistics for pruning.
    """
    keys = list(keys)
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
       .write.mode("overwrite").parquet(target))


def write_with_bloom(df: DataFrame, target: str, cols: Sequence[str],
                     sort_cols: Sequence[str] | None = None, expected_ndv: int = 1_000_000) -> None:
    """Equality-lookup acceleration: Parquet bloom filters per column, and
    row-group min/max from sorting on the first column."""
    w = df.sortWithinPartitions(*(sort_cols or cols[:1])).write.mode("overwrite")
    for c in cols:
        w = (w.option(f"parquet.bloom.filter.enabled#{c}", "true")
              .option(f"parquet.bloom.filter.expected.ndv#{c}", str(expected_ndv)))
    w.parquet(target)


#: Keys that are looked up by value; more are joined.
LOOKUP_VALUES = 1000


def lookup(spark: SparkSession, target: str, col: str, keys: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Rows of a layout whose ``col`` is one of ``keys`` (its first column).

    Few keys become values of a pushed-down IN filter, so row groups are
    skipped by their statistics and bloom filters; more keys are a semi-join,
    which Spark narrows by a run-time bloom filter of the keys where the
    table is large enough to gain from it.
    """
    table = (spark.read.schema(schema) if schema is not None else spark.read).parquet(target)
    wanted = keys.select(F.col(keys.columns[0]).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    few = wanted.limit(LOOKUP_VALUES + 1).collect()                  # bounded
    if len(few) <= LOOKUP_VALUES:
        return table.filter(F.col(col).isin([r["_key"] for r in few]))
    return table.join(wanted, table[col] == wanted["_key"], "left_semi")


def event_rows(events: DataFrame, event_type, details, records_affected) -> DataFrame:
    """Shape rows for the event log: uuid id, event time, VARIANT details.

    ``details`` is a Column of JSON text (e.g. ``to_json(struct(...))``) and
    is parsed into a VARIANT.
    """
    return events.select(
        F.expr("uuid()").alias("event_id"),
        (event_type if not isinstance(event_type, str) else F.lit(event_type)).alias("event_type"),
        F.current_timestamp().alias("event_time"),
        F.parse_json(details).alias("details"),
        F.coalesce(records_affected.cast("bigint"), F.lit(0).cast("bigint")).alias("records_affected"))


def append_events(rows: DataFrame, target: str) -> None:
    """Append shaped rows (``event_rows``) that need no replay key."""
    append(rows, f"{target.rstrip('/')}/_key=none")


def log_event(spark: SparkSession, target: str, event_type: str, details: dict | None,
              records_affected: int = 0, key: str | None = None) -> None:
    """Write one audit row; see ``log_events``."""
    log_events(spark, target, [(event_type, details, records_affected)], key)


def log_events(spark: SparkSession, target: str, events: Sequence[tuple[str, dict | None, int]],
               key: str | None = None) -> None:
    """Write audit rows (event_type, details, records_affected) as one set
    (from driver-side control flow such as a ``foreachBatch`` body).

    Every row lies in a ``_key=`` folder. With ``key`` (e.g. ``"b42"``) the
    set replaces the folder of that key, so a replayed micro-batch does not
    log twice; rows without a key are appended to the folder ``_key=none``.
    """
    given = spark.createDataFrame([(t, json.dumps(d) if d is not None else "null", int(n)) for t, d, n in events],
                                  "t string, d string, n long").coalesce(1)
    rows = event_rows(given, F.col("t"), F.col("d"), F.col("n"))
    (rows.write.mode("append" if key is None else "overwrite")
     .parquet(f"{target.rstrip('/')}/_key={'none' if key is None else key}"))


def read_event_log(spark: SparkSession, target: str) -> DataFrame:
    """All rows of the log, keyed or not."""
    return spark.read.option("basePath", target).parquet(f"{target.rstrip('/')}/_key=*").drop("_key")
