"""SparkSession construction and shared-folder helpers.

On a cluster the session already exists and carries its own settings; the
library only *reads* them. ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "tidemark") -> SparkSession:
    """A local session tuned like the cluster profile (UTC, ANSI, AQE).

    The web UI stays off; the checkpoint folder is only set when the
    session does not name one already.
    """
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = SparkSession.builder
    event_dir = os.environ.get("TIDEMARK_EVENT_LOG_DIR")
    if event_dir:                       # stage/task timings, read offline (no UI)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no per-call Python stack capture while composing long plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEM", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Only a local session (tests) gets a fresh folder of this machine when
    none is configured; a cluster must name a shared folder itself.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a path of ``scratch_path`` with all below it, once nothing reads
    it any more (tables that a caller only counts would add up otherwise)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
