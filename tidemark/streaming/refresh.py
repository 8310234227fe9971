"""Continuously refreshed tables (declarative result + freshness target).

``refresh_stream`` watches the base table's folder. For each micro-batch
of new base rows it finds the affected keys (e.g. tickers), recomputes the
table body for those keys only (the base is restricted to the affected keys
by a semi-join before any window or aggregate runs) and writes a new version with
the affected keys replaced. Row-frame windows are not allowed on streams,
so the per-key recompute happens in the ``foreachBatch`` body, which is a
normal batch plan. Trigger = the target lag: ``processingTime`` of 1, 5 or
10 minutes in production, ``availableNow`` in tests.

``last_bars_stream`` keeps what the recompute needs, each key's last rows, in
the state store instead (``transformWithState``), so a micro-batch reads none
of the base.

``append_stream`` is the stateless case (row-wise bodies such as the CEO
sentiment table): a plain streaming projection appended to Parquet.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from .store import PartitionedTable, VersionedTable

Body = Callable[[DataFrame], DataFrame]

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

TARGET_LAG = {
    "dt_earnings_sentiment": "5 minutes",
    "dt_filing_risk_signals": "10 minutes",
    "dt_price_summary": "1 minute",
}


def _same(keys: Sequence[str]):
    """Null-safe equality with the affected keys (``_k0``, ``_k1``, ...)."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])


def affected_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return batch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()


def restrict_to_keys(df: DataFrame, affected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``affected`` (a NULL key is a key).

    Always one semi-join; Spark broadcasts or filters at run time by the
    measured size of the affected keys.
    """
    return df.join(affected_keys(affected, keys), _same(keys), "left_semi")


def refresh_batch_body(spark: SparkSession, body: Body, base_dir: str, schema: T.StructType,
                       store: VersionedTable | PartitionedTable, keys: Sequence[str]):
    """With a ``PartitionedTable`` the affected keys are its partition columns
    (or the keys of its hash buckets), and nothing but their partitions is
    written; a ``VersionedTable`` is written whole."""
    keys = list(keys)

    def run(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        if isinstance(store, PartitionedTable):
            base = spark.read.schema(schema).parquet(base_dir)
            put = store.replace_keys if store.keys else store.replace
            put(store.batches.read(version) if store.committed(version) else
                body(restrict_to_keys(base, batch.select(*keys), keys)), version)
            return
        if store.committed(version):
            return
        affected = batch.select(*keys)
        base = spark.read.schema(schema).parquet(base_dir)
        fresh = body(restrict_to_keys(base, affected, keys))
        prev = store.latest(below=version)
        if prev is None:
            new = fresh
        else:
            new = store.read(prev).join(affected_keys(affected, keys), _same(keys), "left_anti").unionByName(fresh)
        store.write(new, version)
    return run


def refresh_stream(spark: SparkSession, body: Body, base_dir: str, schema: T.StructType,
                   target_root: str, keys: Sequence[str], checkpoint: str,
                   trigger: dict | None = None, max_files_per_trigger: int | None = None,
                   lag: str = "1 minute", by_partition: bool = False, buckets: int | None = None) -> StreamingQuery:
    """``by_partition``: the target is partitioned by the keys, and a batch
    rewrites only the partitions of its own keys. That is for keys of few
    values (days); with ``buckets`` it is partitioned by a hash of the keys."""
    store = (PartitionedTable(spark, target_root, key=keys, buckets=buckets) if buckets else
             PartitionedTable(spark, target_root, keys) if by_partition else VersionedTable(spark, target_root))
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    w = (reader.parquet(base_dir).writeStream
         .foreachBatch(refresh_batch_body(spark, body, base_dir, schema, store, keys))
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": lag})).start()


def append_stream(spark: SparkSession, body: Body, base_dir: str, schema: T.StructType,
                  target: str, checkpoint: str, trigger: dict | None = None,
                  lag: str = "5 minutes") -> StreamingQuery:
    stream = body(spark.readStream.schema(schema).parquet(base_dir))
    w = (stream.writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"processingTime": lag})).start()


class LastRows(StatefulProcessor):
    """State of a key: its last ``n`` rows by (order, tie), and so many more that
    one of them has a value; a row that comes again replaces its older form.
    Gives out all kept rows whenever new ones arrive."""

    def __init__(self, schema: T.StructType, order: str, tie: str, value: str, n: int):
        self.schema, self.n = schema, n
        self.names = schema.fieldNames()
        self.at = self.names.index(order), self.names.index(tie), self.names.index(value)

    def init(self, handle) -> None:
        self.rows = handle.getListState("rows", self.schema)

    def _kept(self, rows: dict) -> dict:
        keys = sorted(rows, key=lambda k: tuple((x is not None, x) for x in k))
        valued = [i for i, k in enumerate(keys) if rows[k][self.at[2]] is not None]
        # the last row whose frame of n rows holds a value, and that frame
        last = min(len(keys) - 1, valued[-1] + self.n - 1) if valued else len(keys) - 1
        return {k: rows[k] for k in keys[max(0, last - self.n + 1):]}

    def handleInputRows(self, key, rows, timerValues):
        order, tie, _ = self.at
        held = {(r[order], r[tie]): tuple(r) for r in self.rows.get()}
        for r in rows:
            held[r[order], r[tie]] = tuple(r[name] for name in self.names)
            if len(held) > 64 * self.n:                    # a long history arrives at once
                held = self._kept(held)
        held = self._kept(held)
        self.rows.put(list(held.values()))
        yield from (Row(**dict(zip(self.names, r))) for r in held.values())

    def close(self) -> None:
        pass


def last_bars_stream(spark: SparkSession, bars: DataFrame, summary: Body, target_root: str, checkpoint: str,
                     key: str = "ticker", order: str = "price_date", tie: str = "price_id", value: str = "close_price",
                     n: int = 50, trigger: dict | None = None, lag: str = "1 minute", buckets: int = 64) -> StreamingQuery:
    """``bars`` (a streaming table) -> per touched key ``summary`` of its last
    ``n`` bars, which live in the state store; the target is partitioned by
    a hash of the key, and a batch rewrites the buckets of its keys. Bars older
    than a key's kept ones change nothing. The state is kept by RocksDB."""
    store = PartitionedTable(spark, target_root, key=key, buckets=buckets)
    last = bars.groupBy(key).transformWithState(LastRows(bars.schema, order, tie, value, n), bars.schema, "Update", "None")

    def body(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        store.replace_keys(store.batches.read(version) if store.committed(version) else summary(batch), version)

    w = last.writeStream.outputMode("update").foreachBatch(body).option("checkpointLocation", checkpoint)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:                                   # a query keeps the settings it was started with
        return w.trigger(**(trigger or {"processingTime": lag})).start()
    finally:
        spark.conf.set(STATE_STORE, before)
