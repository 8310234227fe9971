"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Labels may be learned from rows whose crc32(doc_id as text) mod FOLDS is not 0.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back.

    Cuts the lineage with files that survive a lost executor, so what
    follows never repeats the work above it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``index`` (from 0 in their group, by ``order``) and
    ``total`` (rows of the group).

    A global sort in ranges cuts a group of any size over many tasks; a small
    table of counts per (group, range) says how many rows come before. The
    group must not be null; ``order`` should tell all rows apart.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id())
                         .withColumn("_range", F.shiftright("_at", 33)), "numbered")
    counts = placed.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bases = counts.select(group, "_range", "_first", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
                          F.sum("_n").over(Window.partitionBy(group)).alias("total"))
    return (placed.join(bases, [group, "_range"])
            .withColumn("index", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_at", "_range", "_first", "_before"))


#: Keys that ``join_hot`` broadcasts at most, and rows a key needs for that at least.
HOT_KEYS, HOT_ROWS = 100_000, 256


def join_hot(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` joined with ``groups`` (a row per key, whose column ``size``
    says how many of the ``total`` rows have it), no key in one task alone.

    Keys with more than their share of rows, fewer than HOT_KEYS by count, are
    broadcast, and their rows stay where they are; all others are shuffled.
    """
    least = max(HOT_ROWS, -(-total // HOT_KEYS))
    hot, cold = F.broadcast(groups.filter(F.col(size) > least)), groups.filter(F.col(size) <= least)
    return rows.join(hot, key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that labels are never learned from (null id: held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def fold_of(doc_id: int) -> int:
    """The same fold in Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS
