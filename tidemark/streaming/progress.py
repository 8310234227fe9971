"""Run log of streaming queries: every micro-batch and every end becomes a row.

``RunLog`` is a query listener: it takes down each progress as it happens
(``recentProgress`` forgets after a hundred) and why a query ended, and writes
them to the log in the shared folder, one file set per flush. The refresh and
job monitors read that log.
"""

from __future__ import annotations

import re
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

RUNS = ("name string, run_id string, batch_id long, ts string, duration_ms long, state string, input_rows long, "
        "refresh_reason string, error_code string, error_message string")


class RunLog(StreamingQueryListener):
    """Listener that logs to ``path``; use it as a context manager, or add it
    to ``spark.streams`` and call ``flush`` now and then. Rows wait in memory
    until the next flush: one per micro-batch, ``flush_rows`` at most."""

    def __init__(self, spark: SparkSession, path: str, flush_rows: int = 1000):
        self.spark, self.path, self.flush_rows = spark, path, flush_rows
        self._rows: list[tuple] = []
        self._names: dict[str, str] = {}
        self._ended: set[str] = set()
        self._lock = threading.Lock()

    # ------------------------------------------------------------- events
    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        reason = "INITIAL" if p.batchId == 0 else "NEW_DATA" if p.numInputRows else "NO_DATA"
        took = (p.durationMs or {}).get("triggerExecution", 0)
        self._add((p.name or str(p.id), str(p.runId), p.batchId, p.timestamp, int(took), "SUCCEEDED", int(p.numInputRows), reason, None, None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            name = self._names.get(str(event.runId), str(event.id))
            code = getattr(event, "errorClassOnException", None) or "STREAM_FAILED"
            self._add((name, str(event.runId), None, None, 0, "FAILED", 0, "FAILED", code, told(str(event.exception))))
        self._ended.add(str(event.runId))

    def _add(self, row: tuple) -> None:
        with self._lock:
            self._rows.append(row)

    # ------------------------------------------------------------ writing
    def flush(self) -> None:
        """Append what has come in; an end without a time is given the present."""
        with self._lock:
            rows, self._rows = self._rows, []
        for at in range(0, len(rows), self.flush_rows):
            df = self.spark.createDataFrame(rows[at:at + self.flush_rows], RUNS).coalesce(1)
            df.withColumn("ts", F.coalesce("ts", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
                          ).write.mode("append").parquet(self.path)

    def __enter__(self) -> "RunLog":
        self.spark.streams.addListener(self)
        return self

    def settle(self, seconds: float = 30.0) -> None:
        """Wait until the ends of all queries that no longer run have been told."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            active = {str(q.runId) for q in self.spark.streams.active}
            if not set(self._names) - self._ended - active:
                return
            time.sleep(0.05)

    def __exit__(self, *_) -> None:
        self.settle()
        self.spark.streams.removeListener(self)
        self.flush()


def told(exception: str) -> str:
    """The line that says what went wrong: that of a Python error if one was
    raised in a batch, else the first."""
    lines = [x.strip() for x in exception.splitlines() if x.strip()]
    raised = [x for x in lines if re.match(r"[\w.]*(Error|Exception): ", x) and not x.startswith("py4j.")]
    return (raised or lines or [""])[0][:2000]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The log in the shape that the monitors read, with reason, message and duration."""
    return spark.read.schema(RUNS).parquet(path).select(
        "name", F.to_timestamp_ntz(F.regexp_replace("ts", "Z$", "")).alias("completed_time"), "state", "input_rows", "error_code",
        "error_message", "refresh_reason", "batch_id", "duration_ms", "run_id")


def progress_log(spark: SparkSession, queries: dict[str, StreamingQuery]) -> DataFrame:
    """The same log from queries at hand, as far as their progress is remembered."""
    rows = []
    for name, q in queries.items():
        failed = q.exception() is not None if not q.isActive else False
        for p in q.recentProgress:
            rows.append((name, p["timestamp"], "FAILED" if failed else "SUCCEEDED",
                         int(p.get("numInputRows") or 0)))
    df = spark.createDataFrame(rows, "name string, ts string, state string, input_rows long")
    return df.select("name", F.to_timestamp_ntz(F.regexp_replace("ts", "Z$", "")).alias("completed_time"),
                     "state", "input_rows", F.lit(None).cast("string").alias("error_code"))
