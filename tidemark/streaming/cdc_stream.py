"""Continuous change capture: detect -> upsert -> log as one Structured
Streaming query.

The file source's checkpoint plays the role of the stream offset; every
micro-batch is a set of change rows (``action``, ``is_update`` plus the
table's columns). ``foreachBatch`` upserts the INSERT actions into the
partitions that they touch, committed under the batch id, then logs the detection and the
processed row count as one row set. Production uses ``trigger(processingTime="1 minute")``;
tests use ``availableNow``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc import upsert
from ..session import scratch_path
from ..sources.sinks import log_events
from .store import PartitionedTable, VersionedTable


def cdc_batch_body(spark: SparkSession, store: VersionedTable | PartitionedTable, key,
                   update_cols: Sequence[str], insert_cols: Sequence[str] | None = None,
                   log_path: str | None = None, detect_event: str = "EARNINGS_CDC",
                   done_event: str = "EARNINGS_PROCESSED", schema: T.StructType | None = None):
    """foreachBatch body: upsert the INSERT actions into version
    ``batch_id + 1``, then log detection and completion as one row set. With a
    ``PartitionedTable`` (of rows of ``schema``) only the partitions that the
    batch touches are read and rewritten."""
    def body(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1                    # version 0 is the initial snapshot
        if isinstance(store, VersionedTable) and store.committed(version):
            return                                # replayed after a failure: already applied
        counted = Observation(f"inserts-{batch_id}-{version}")
        inserts = batch.filter(F.col("action") == "INSERT").observe(counted, F.count(F.lit(1)).alias("n"))
        inserts = materialized(inserts, "inserts")
        if isinstance(store, PartitionedTable):
            done = store.committed(version)       # then only put into the table again
            store.replace(store.batches.read(version) if done else
                          upsert(store.read(schema, inserts), inserts, key, update_cols, insert_cols), version)
        else:
            store.write(upsert(store.read(store.latest(below=version)), inserts, key, update_cols, insert_cols), version)
        if log_path:
            n = counted.get["n"]
            log_events(spark, log_path, [
                (detect_event, {"source": "change_stream", "action": "pending", "batch_id": batch_id}, n),
                (done_event, {"status": "completed", "batch_id": batch_id}, n)], key=f"b{batch_id}")
    return body


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, counted on the way, read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_cdc_stream(spark: SparkSession, src_dir: str, schema: T.StructType, store: VersionedTable | PartitionedTable,
                   key, update_cols: Sequence[str], checkpoint: str,
                   trigger: dict | None = None, log_path: str | None = None,
                   max_files_per_trigger: int | None = None,
                   insert_cols: Sequence[str] | None = None,
                   table_schema: T.StructType | None = None) -> StreamingQuery:
    """The target is a ``PartitionedTable`` (a batch rewrites the partitions
    it touches) or a ``VersionedTable`` (the whole table per micro-batch)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    w = (reader.parquet(src_dir).writeStream
         .foreachBatch(cdc_batch_body(spark, store, key, update_cols, insert_cols, log_path, schema=table_schema))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"processingTime": "1 minute"}))
    return w.start()
