"""File sources: headered CSV with a declared schema, Parquet tables, and
ingest-time column defaults."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',          # RFC 4180: a quote inside a quoted field is doubled
    "ignoreLeadingWhiteSpace": "false",    # keep values byte for byte (the writer
    "ignoreTrailingWhiteSpace": "false",   # would otherwise trim them)
    "mode": "FAILFAST",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "dateFormat": "yyyy-MM-dd",
}


# Reading only: an empty unquoted field is NULL (parser default) while a
# quoted "" stays an empty string; no real value equals this sentinel.
READ_NULL_SENTINEL = "\u0000"


def load_csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Read CSV into a declared schema (never inferred; bad rows fail).

    Pass ``multiLine="true"`` for files whose quoted fields span lines; such
    files can't be split, so it is off by default.
    """
    opts = {**CSV_OPTIONS, "nullValue": READ_NULL_SENTINEL, **options}
    return spark.read.schema(schema).options(**opts).csv(path)


def write_csv(df: DataFrame, path: str, **options) -> None:
    opts = {k: v for k, v in {**CSV_OPTIONS, **options}.items() if k not in ("mode", "multiLine")}
    df.write.mode("overwrite").options(**opts).csv(path)


def with_defaults(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    """Fill column defaults at ingest: NULL -> default. A value of
    ``"now"`` for a timestamp column means the load time."""
    repl = {}
    for c, v in defaults.items():
        if isinstance(v, str) and v == "now":
            repl[c] = F.coalesce(F.col(c), F.current_timestamp().cast(df.schema[c].dataType))
        else:
            repl[c] = F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
    return df.withColumns(repl)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
