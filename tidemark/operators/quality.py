"""Data-quality expectations, suites, gate, profile and column tests.

A suite compiles to **one** aggregate over its table for all row-level
checks (plus one grouped aggregate per uniqueness check), then the single
result row is stacked into one row per check. Value-level checks ignore
NULLs except the not-null check.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    kind: str                  # not_null | unique | in_set | regex | between | length_between | row_count
    column: str | None = None
    lo: Any = None
    hi: Any = None
    values: tuple = ()
    pattern: str | None = None

    @property
    def expectation(self) -> str:
        return {
            "not_null": "expect_column_values_to_not_be_null",
            "unique": "expect_column_values_to_be_unique",
            "in_set": "expect_column_values_to_be_in_set",
            "regex": "expect_column_values_to_match_regex",
            "between": "expect_column_values_to_be_between",
            "length_between": "expect_column_value_lengths_to_be_between",
            "row_count": "expect_table_row_count_to_be_between",
        }[self.kind]


TICKER_RE = "^[A-Z]{1,5}$"

# The three expectation suites (fixed values, in document order).
SUITES: dict[str, list[Check]] = {
    "earnings_calls": [
        Check("not_null", "transcript_text"),
        Check("not_null", "ticker"),
        Check("not_null", "call_date"),
        Check("regex", "ticker", pattern=TICKER_RE),
        Check("between", "confidence_score", 0.0, 1.0),
        Check("length_between", "transcript_text", 50, 500000),
        Check("in_set", "call_type", values=("earnings", "conference", "investor_day", "guidance")),
        Check("row_count", None, 10, 100000),
    ],
    "sec_filings": [
        Check("not_null", "filing_id"),
        Check("not_null", "section_text"),
        Check("not_null", "filing_type"),
        Check("in_set", "filing_type", values=("10-K", "10-Q", "8-K", "DEF 14A", "S-1", "10-K/A", "10-Q/A")),
        Check("regex", "ticker", pattern=TICKER_RE),
        Check("length_between", "section_text", 100, 1000000),
        Check("unique", "filing_id"),
        Check("not_null", "filing_date"),
        Check("between", "pages_count", 1, 1000),
        Check("row_count", None, 5, 200000),
    ],
    "stock_prices": [
        Check("not_null", "close_price"),
        Check("between", "close_price", 0.01, 100000),
        Check("between", "open_price", 0.01, 100000),
        Check("between", "high_price", 0.01, 100000),
        Check("between", "low_price", 0.01, 100000),
        Check("not_null", "price_date"),
        Check("unique", "price_id"),
        Check("regex", "ticker", pattern=TICKER_RE),
        Check("not_null", "volume"),
        Check("between", "volume", 0, 10000000000),
        Check("between", "price_date", "2020-01-01", "2030-12-31"),
        Check("row_count", None, 100, 5000000),
    ],
}


def _lit(df: DataFrame, col: str, v) -> Column:
    typ = df.schema[col].dataType
    if isinstance(typ, T.DateType) and isinstance(v, str):
        return F.lit(_dt.date.fromisoformat(v))
    return F.lit(v).cast(typ) if not isinstance(typ, (T.DateType, T.TimestampType)) else F.lit(v)


def _row_level(df: DataFrame, c: Check) -> tuple[Column, Column | None]:
    """(evaluated, unexpected) aggregate expressions for one check."""
    n_all = F.count(F.lit(1))
    if c.kind == "row_count":
        return n_all, None
    x = F.col(c.column)
    if c.kind == "not_null":
        return n_all, F.count_if(x.isNull())
    n = F.count(x)
    if c.kind == "in_set":
        return n, F.count_if(~x.isin(*c.values))
    if c.kind == "regex":
        return n, F.count_if(~x.rlike(c.pattern))
    if c.kind == "between":
        return n, F.count_if((x < _lit(df, c.column, c.lo)) | (x > _lit(df, c.column, c.hi)))
    if c.kind == "length_between":
        ln = F.length(x)
        return n, F.count_if((ln < c.lo) | (ln > c.hi))
    raise ValueError(c.kind)


def validate(df: DataFrame, table: str, suite: Sequence[Check]) -> DataFrame:
    """One row per check: table, expectation, column, evaluated, unexpected, success.

    Row checks are one global aggregate (no data shuffle, only the columns
    they name); each uniqueness check groups its key column alone.
    """
    row_checks = [(i, c) for i, c in enumerate(suite) if c.kind != "unique"]
    parts = []
    if row_checks:
        aggs, stacked = [], []
        for i, c in row_checks:
            ev, un = _row_level(df, c)
            aggs += [ev.cast("bigint").alias(f"_e{i}"),
                     (un if un is not None else F.lit(None)).cast("bigint").alias(f"_u{i}")]
            ok = f"_e{i} BETWEEN {int(c.lo)} AND {int(c.hi)}" if c.kind == "row_count" else f"_u{i} = 0"
            col = f"'{c.column}'" if c.column else "CAST(NULL AS STRING)"
            stacked.append(f"{i}, '{c.expectation}', {col}, _e{i}, _u{i}, {ok}")
        parts.append(df.agg(*aggs).selectExpr(
            f"stack({len(stacked)}, {', '.join(stacked)}) "
            "AS (check_index, expectation, column_name, evaluated, unexpected, success)"))
    for i, c in enumerate(suite):
        if c.kind != "unique":
            continue
        x = F.col(c.column)
        dup = df.filter(x.isNotNull()).groupBy(x).agg(F.count(F.lit(1)).alias("_n"))
        stats = dup.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("evaluated"),
                        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0))
                        .cast("bigint").alias("unexpected"))
        parts.append(stats.select(F.lit(i).alias("check_index"), F.lit(c.expectation).alias("expectation"),
                                  F.lit(c.column).alias("column_name"), "evaluated", "unexpected",
                                  (F.col("unexpected") == 0).alias("success")))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select(F.lit(table).alias("table_name"), F.col("check_index").cast("int"),
                      "expectation", "column_name", "evaluated", "unexpected", "success")


def validate_all(tables: dict[str, DataFrame], suites: dict[str, list[Check]] | None = None) -> DataFrame:
    suites = suites or SUITES
    return reduce(lambda a, b: a.unionByName(b),
                  [validate(tables[t], t, s) for t, s in suites.items() if t in tables])


def validate_kind(tables: dict[str, DataFrame], kind: str,
                  suites: dict[str, list[Check]] | None = None) -> DataFrame:
    """All uses of one expectation type across the suites."""
    suites = suites or SUITES
    parts = []
    for t, s in suites.items():
        picked = [(i, c) for i, c in enumerate(s) if c.kind == kind]
        if picked and t in tables:
            sub = validate(tables[t], t, [c for _, c in picked])
            idx = {j: i for j, (i, _) in enumerate(picked)}
            mapping = F.create_map(*[x for j, i in idx.items() for x in (F.lit(j), F.lit(i))])
            parts.append(sub.withColumn("check_index", mapping[F.col("check_index")].cast("int")))
    return reduce(lambda a, b: a.unionByName(b), parts)


class QualityGateError(RuntimeError):
    pass


def gate_rows(results: DataFrame) -> DataFrame:
    return (results.groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("checks"),
                 F.count_if(~F.col("success")).alias("failed_checks"))
            .withColumn("passed", F.col("failed_checks") == 0))


def quality_gate(results: DataFrame, raise_on_fail: bool = True) -> DataFrame:
    """Gate rows per table; raises when any check failed (stop before staging)."""
    rows = gate_rows(results)
    if raise_on_fail:
        failed = rows.filter(~F.col("passed")).select("table_name", "failed_checks").collect()
        if failed:  # one row per table: bounded by the number of suites
            raise QualityGateError(", ".join(f"{r.table_name}: {r.failed_checks} failed" for r in failed))
    return rows


def _measure(field: T.StructField):
    """A column as a number: numbers and booleans themselves, strings and
    binaries by length, dates as days and timestamps as seconds since 1970."""
    x, kind = F.col(field.name), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
        return F.length(x).cast("double")
    if isinstance(kind, T.DateType):
        return F.datediff(x, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(kind), x).cast("double") / 1e6
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return x.cast("double")
    return None


def profile(df: DataFrame, exact: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: non-null, null, distinct, and min, max, mean, stddev of
    its measure (see ``_measure``; NULL for nested types).

    One aggregate; distinct is HyperLogLog++ unless ``exact``.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        x, m = F.col(f.name), _measure(f)
        m = F.lit(None).cast("double") if m is None else m
        d = F.count_distinct(x) if exact else F.approx_count_distinct(x)
        aggs += [F.count(x).alias(f"_nn{i}"), d.cast("bigint").alias(f"_d{i}"),
                 F.min(m).alias(f"_mi{i}"), F.max(m).alias(f"_ma{i}"),
                 F.avg(m).alias(f"_av{i}"), F.stddev_samp(m).alias(f"_sd{i}")]
    rows = ", ".join(f"'{f.name}', _nn{i}, _n - _nn{i}, _d{i}, _mi{i}, _ma{i}, _av{i}, _sd{i}"
                     for i, f in enumerate(fields))
    return df.agg(*aggs).selectExpr(
        f"stack({len(fields)}, {rows}) AS (column_name, non_null_count, null_count, distinct_count, "
        "min_value, max_value, mean_value, stddev_value)")


def test_unique(df: DataFrame, col: str) -> DataFrame:
    """Column uniqueness test: offending values with their multiplicity."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def test_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def test_range(df: DataFrame, col: str = "sentiment_score", lo: float = -1.0, hi: float = 1.0,
               keep: Sequence[str] = ("ticker", "call_date", "sentiment_score", "speaker_name",
                                      "speaker_role")) -> DataFrame:
    return df.filter((F.col(col) < lo) | (F.col(col) > hi)).select(*keep)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b),
                  [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
                   for n, df in tables.items()])


def date_ranges(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b),
                  [df.agg(F.min(c).alias("min_date"), F.max(c).alias("max_date"))
                   .select(F.lit(n).alias("table_name"), "min_date", "max_date")
                   for n, (df, c) in tables.items()])


def coverage(df: DataFrame, key: str = "ticker") -> DataFrame:
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"))
            .orderBy(F.col("record_count").desc(), F.col(key)))
