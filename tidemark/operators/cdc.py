"""Change capture between two versions of a keyed table, and upsert.

``cdc_changes`` is one full-outer join on the key (both versions shuffled
by key once); rows compare null-safely as whole structs. An update yields
a DELETE + INSERT pair flagged ``is_update`` (stream semantics).
``upsert`` is the MERGE ... WHEN MATCHED UPDATE / WHEN NOT MATCHED INSERT
as another keyed full-outer join that produces the next snapshot.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def cdc_changes(before: DataFrame, after: DataFrame, key) -> DataFrame:
    keys = _keys(key)
    cols = list(after.columns)
    b = before.select(*[F.col(k) for k in keys], F.struct(*[F.col(c) for c in cols]).alias("_b"))
    a = after.select(*[F.col(k) for k in keys], F.struct(*[F.col(c) for c in cols]).alias("_a"))
    j = b.join(a, keys, "full_outer")

    def change(row, action, upd):
        return F.struct(row.alias("r"), F.lit(action).alias("action"), F.lit(upd).alias("is_update"))

    ins, dele = F.col("_a"), F.col("_b")
    changes = (F.when(dele.isNull(), F.array(change(ins, "INSERT", False)))
               .when(ins.isNull(), F.array(change(dele, "DELETE", False)))
               .when(~dele.eqNullSafe(ins), F.array(change(dele, "DELETE", True),
                                                    change(ins, "INSERT", True))))
    # identical versions give a NULL array, which explode drops
    out = j.select(F.explode(changes).alias("_c"))
    return out.select(*[F.col(f"_c.r.{c}").alias(c) for c in cols],
                      F.col("_c.action").alias("action"), F.col("_c.is_update").alias("is_update"))


def cdc_changes_fingerprint(before: DataFrame, after: DataFrame, key) -> DataFrame:
    """Same change rows as ``cdc_changes``, for wide rows.

    Only (key, SHA-256 of the row's JSON) of both versions goes through the
    keyed full-outer join; full rows are then fetched for the changed keys
    alone (a broadcast semi-join when few keys changed, as AQE measures).
    Exact up to SHA-256 collisions; -0.0 and 0.0 fingerprint differently.
    """
    keys = _keys(key)
    cols = list(after.columns)

    def fingerprint(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256).alias(name))

    j = fingerprint(before, "_hb").join(fingerprint(after, "_ha"), keys, "full_outer")
    kind = (F.when(F.col("_hb").isNull(), "I").when(F.col("_ha").isNull(), "D")
            .when(F.col("_hb") != F.col("_ha"), "U"))
    changed = j.select(*keys, kind.alias("_k")).filter(F.col("_k").isNotNull())
    ins = (after.join(changed.filter(F.col("_k") != "D"), keys, "inner")
           .select(*cols, F.lit("INSERT").alias("action"), (F.col("_k") == "U").alias("is_update")))
    dels = (before.select(*cols).join(changed.filter(F.col("_k") != "I"), keys, "inner")
            .select(*cols, F.lit("DELETE").alias("action"), (F.col("_k") == "U").alias("is_update")))
    return ins.unionByName(dels)


# ------------------------------------------------------------ bucket digests
BUCKET = "_bucket"


def _digest(cols: Sequence[str]) -> list[Column]:
    """Order-free digest of rows: their number and the sum of their hashes
    (nulls marked, so that a value can't move to another column unseen)."""
    row = F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).alias("hashes")]


def bucketed(df: DataFrame, key, buckets: int) -> DataFrame:
    """The rows with the hash bucket of their key."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*_keys(key)), F.lit(buckets)).cast("int"))


def bucket_digests(df: DataFrame, key, buckets: int = 1024) -> DataFrame:
    """(_bucket, rows, hashes): at most ``buckets`` rows, whatever the table; to
    be kept with a version of it."""
    return bucketed(df, key, buckets).groupBy(BUCKET).agg(*_digest(df.columns))


def changed_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose digests differ between two versions."""
    pair = before.withColumnsRenamed({"rows": "r1", "hashes": "h1"}).join(after, BUCKET, "full")
    return pair.filter(~(F.col("r1").eqNullSafe(F.col("rows")) & F.col("h1").eqNullSafe(F.col("hashes")))).select(BUCKET)


def cdc_changes_by_digest(before: DataFrame, after: DataFrame, key, buckets: int = 1024) -> DataFrame:
    """As ``cdc_changes``: both versions are digested bucket by bucket, and only
    rows of buckets that differ go through the keyed join. Exact but for a
    collision of 64-bit hash sums."""
    cols = after.columns
    changed = changed_buckets(bucket_digests(before.select(*cols), key, buckets), bucket_digests(after, key, buckets))
    part = lambda df: bucketed(df, key, buckets).join(changed, BUCKET, "left_semi").select(*cols)
    return cdc_changes(part(before), part(after), key)


def store_version(df: DataFrame, path: str, key, buckets: int = 64) -> None:
    """Write a version partitioned by key bucket, with its digests beside it."""
    bucketed(df, key, buckets).write.partitionBy(BUCKET).parquet(f"{path}/rows")
    bucket_digests(df, key, buckets).coalesce(1).write.parquet(f"{path}/digests")


def stored_changes(spark: SparkSession, before: str, after: str, key, schema: StructType) -> DataFrame:
    """Changes between two stored versions: their digests (a row per bucket)
    say which partitions differ, and only these are read."""
    digests = [spark.read.parquet(f"{p}/digests") for p in (before, after)]
    touched = [r[0] for r in changed_buckets(*digests).collect()]       # at most the number of buckets
    whole = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    old, new = (spark.read.schema(whole).parquet(f"{p}/rows").filter(F.col(BUCKET).isin(touched)).drop(BUCKET) for p in (before, after))
    return cdc_changes(old, new, key)


def has_data(versions: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per stream (before, after): are changes pending? One digest of each
    version, no join of rows and no shuffle but of one row a task."""
    parts = []
    for name, (before, after) in versions.items():
        b = before.select(*after.columns).agg(*_digest(after.columns)).select(F.struct("*").alias("b"))
        a = after.agg(*_digest(after.columns)).select(F.struct("*").alias("a"))
        parts.append(b.join(a, F.lit(True)).select(F.lit(name).alias("stream_name"), (F.col("a") != F.col("b")).alias("has_data")))
    return reduce(DataFrame.unionByName, parts)


def change_counts(changes: dict[str, DataFrame], time_col: str | None = None) -> DataFrame:
    """Per stream: inserts / updates / deletes (an update counted once) and
    the latest change time."""
    parts = []
    for name, ch in changes.items():
        t = F.col(time_col) if time_col and time_col in ch.columns else F.lit(None).cast("timestamp_ntz")
        parts.append(ch.agg(
            F.count_if((F.col("action") == "INSERT") & ~F.col("is_update")).alias("total_inserts"),
            F.count_if((F.col("action") == "INSERT") & F.col("is_update")).alias("total_updates"),
            F.count_if((F.col("action") == "DELETE") & ~F.col("is_update")).alias("total_deletes"),
            F.max(t).cast("timestamp_ntz").alias("last_activity"))
            .select(F.lit(name).alias("stream_name"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def one_per_key(df: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the greatest ``order`` (then the greatest row) wins.

    A partially aggregated ``max_by``, so copies of a hot key collapse on
    the map side; the result is hash-partitioned by key, which the keyed
    join after it reuses.
    """
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(F.col(order), row) if order else row
    best = df.groupBy(*keys).agg(F.max_by(row, ordering).alias("_r"))
    # key columns stay the grouping attributes, so the hash partitioning by
    # key is visible to (and reused by) a following keyed join
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in cols])


def upsert(target: DataFrame, changes: DataFrame, key, update_cols: Sequence[str],
           insert_cols: Sequence[str] | None = None, action_col: str = "action",
           source_order: str | None = None) -> DataFrame:
    """MERGE INTO target USING (changes WHERE action = 'INSERT') ON key.

    Matched rows take ``update_cols`` from the source (other columns keep
    the target's values); unmatched source rows are inserted with
    ``insert_cols`` (others NULL); unmatched target rows are kept. Several
    source rows for one key (which a SQL MERGE rejects) are reduced to one:
    the latest by ``source_order`` if given, else the greatest row.
    """
    keys = _keys(key)
    cols = target.columns
    insert_cols = list(insert_cols or cols)
    src = changes
    if action_col in changes.columns:
        src = changes.filter(F.col(action_col) == "INSERT")
    src = one_per_key(src.select(*[c for c in src.columns if c in cols or c == source_order]),
                      keys, source_order)
    s = src.select(*[F.col(k) for k in keys],
                   F.struct(*[F.col(c) for c in cols if c in src.columns]).alias("_s"))
    t = target.select(*[F.col(k) for k in keys], F.struct(*[F.col(c) for c in cols]).alias("_t"))
    j = t.join(s, keys, "full_outer")
    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    exprs = []
    for c in cols:
        if c in keys:
            exprs.append(F.col(c))
            continue
        tv, sv = F.col(f"_t.{c}"), (F.col(f"_s.{c}") if c in src.columns else F.lit(None))
        ins_v = sv if c in insert_cols else F.lit(None)
        exprs.append(F.when(F.col("_t").isNull(), ins_v)
                     .when(matched & F.lit(c in update_cols), sv)
                     .otherwise(tv).cast(target.schema[c].dataType).alias(c))
    return j.select(*exprs)


def apply_changes(before: DataFrame, changes: DataFrame, key) -> DataFrame:
    """Replay a change set (deletes then inserts) onto a version: for the
    invariant apply(diff(A, B), A) == B."""
    keys = _keys(key)
    cols = before.columns
    deleted = changes.filter(F.col("action") == "DELETE").select(*keys)
    inserted = changes.filter(F.col("action") == "INSERT").select(*cols)
    return before.join(deleted, keys, "left_anti").unionByName(inserted)
