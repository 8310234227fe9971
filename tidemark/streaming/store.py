"""Versioned Parquet snapshots in a shared folder.

Built-in Parquet tables support no MERGE or in-place UPDATE, so each
refresh writes a complete new version directory ``v000042`` and never
overwrites the directory it reads from. A version is visible once Spark's
committer has written its ``_SUCCESS`` marker, so a lost executor or a
replayed micro-batch leaves either no version or a complete one;
re-running batch ``n`` finds version ``n`` committed and skips it
(idempotent ``foreachBatch``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def path(self, version: int) -> str:
        return f"{self.root}/v{version:06d}"

    def committed(self, version: int) -> bool:
        fs, jvm = self._fs()
        return bool(fs.exists(jvm.org.apache.hadoop.fs.Path(self.path(version) + "/_SUCCESS")))

    def versions(self) -> list[int]:
        fs, jvm = self._fs()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("v") and name[1:].isdigit() and self.committed(int(name[1:])):
                out.append(int(name[1:]))
        return sorted(out)

    def latest(self, below: int | None = None) -> int | None:
        vs = [v for v in self.versions() if below is None or v < below]
        return vs[-1] if vs else None

    def read(self, version: int | None = None) -> DataFrame:
        v = self.latest() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(self.path(v))

    def write(self, df: DataFrame, version: int) -> bool:
        """Commit ``df`` as ``version`` unless already committed."""
        if self.committed(version):
            return False
        df.write.mode("overwrite").parquet(self.path(version))
        return True


class PartitionedTable:
    """A plain Parquet table partitioned by columns (or by a hash bucket of a
    key), of which a batch rewrites only the partitions that it touches.

    A batch's new partitions are first committed as a version of ``batches``,
    a replayed batch finds them there; then Spark's dynamic partition
    overwrite puts them into ``table``. Both writes give the same rows however
    often they run.
    """

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, root: str, partitions: Sequence[str] = (), key: Sequence[str] | str = (),
                 buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys = [key] if isinstance(key, str) else list(key)
        self.partitions = list(partitions) or [self.BUCKET]
        self.buckets = buckets
        self.batches = VersionedTable(spark, f"{self.root}/batches")
        self.fresh = VersionedTable(spark, f"{self.root}/fresh")

    @property
    def path(self) -> str:
        return f"{self.root}/table"

    def marked(self, df: DataFrame) -> DataFrame:
        """The rows with the columns that they are partitioned by."""
        if self.partitions != [self.BUCKET]:
            return df
        return df.withColumn(self.BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def committed(self, version: int) -> bool:
        return self.batches.committed(version)

    def _overwrite(self, df: DataFrame) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.partitions).parquet(self.path))

    def create(self, df: DataFrame) -> None:
        self._overwrite(self.marked(df))

    def replace(self, df: DataFrame, version: int) -> bool:
        """Put the partitions that ``df`` holds, whole, in place of the old ones."""
        fresh = not self.committed(version)
        self.batches.write(self.marked(df), version)
        self._overwrite(self.batches.read(version))
        return fresh

    def replace_keys(self, df: DataFrame, version: int) -> bool:
        """Put the rows of ``df`` in place of those that its keys had (a table
        in hash buckets: the number of folders is that of the buckets, however
        many keys there are).

        ``df`` is computed once, into a version of ``fresh``; the buckets that
        it touches are then written whole, with the rows of their other keys.
        """
        if self.committed(version):
            return self.replace(self.batches.read(version), version)
        self.fresh.write(df, version)
        rows = fresh = self.fresh.read(version)
        fs, jvm = self.batches._fs()
        if fs.exists(jvm.org.apache.hadoop.fs.Path(self.path)):
            new = fresh.select(*[F.col(k).alias(f"_n_{k}") for k in self.keys]).distinct()
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in self.keys])
            rows = self.read(fresh.schema, fresh).join(new, same, "left_anti").unionByName(fresh)
        return self.replace(self.marked(rows).repartition(self.BUCKET), version)       # a file per bucket, not per task and bucket

    def read(self, schema: StructType, touched: DataFrame | None = None) -> DataFrame:
        """The rows of the table (of the partitions of the rows ``touched``)."""
        stored = [f for f in schema.fields if f.name not in self.partitions]
        placed = [StructField(self.BUCKET, IntegerType())] if self.partitions == [self.BUCKET] else [schema[c] for c in self.partitions]
        table = self.spark.read.schema(StructType([*stored, *placed])).parquet(self.path)
        if touched is not None:
            at = self.marked(touched).select(*[F.col(c).alias(f"_p_{c}") for c in self.partitions]).distinct()
            same = reduce(lambda a, b: a & b, [table[c].eqNullSafe(at[f"_p_{c}"]) for c in self.partitions])
            table = table.join(at, same, "left_semi")         # partitions pruned at run time
        return table.select(*schema.fieldNames())
