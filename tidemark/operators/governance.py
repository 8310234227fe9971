"""Column masking and row access as DataFrame operators.

The role is a driver-side parameter, so each policy folds to a single
branch at plan time (no per-row role test). ``role`` may also be a Column
for per-row evaluation.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import col_, half_up

# Roles and policy constants (fixed values).
ANALYST, DATA_SCIENCE, ADMIN = "ANALYST_ROLE", "DATA_SCIENCE_ROLE", "ADMIN_ROLE"
SECTOR_TECH, SECTOR_ENERGY = "SECTOR_TECH_ROLE", "SECTOR_ENERGY_ROLE"
ROLES = (ANALYST, DATA_SCIENCE, ADMIN, SECTOR_TECH, SECTOR_ENERGY, "PUBLIC")
FULL_TEXT_ROLES = (ANALYST, DATA_SCIENCE, ADMIN)
SECTOR_ROLES = (SECTOR_TECH, SECTOR_ENERGY)
EXACT_SCORE_ROLES = (ANALYST, DATA_SCIENCE, ADMIN)
VECTOR_ROLES = (DATA_SCIENCE, ADMIN)
ALL_ROWS_ROLES = (ADMIN, ANALYST, DATA_SCIENCE)
ROLE_TICKERS = {
    SECTOR_TECH: ("AAPL", "MSFT", "GOOGL", "NVDA", "META"),
    SECTOR_ENERGY: ("TSLA",),
}


def _in(role, roles: Sequence[str]):
    return role in roles if isinstance(role, str) else col_(role).isin(*roles)


def _choose(role, branches: list[tuple[Sequence[str] | None, Column]]) -> Column:
    """branches: (roles or None for ELSE, value)."""
    if isinstance(role, str):
        for roles, val in branches:
            if roles is None or role in roles:
                return val
    expr = None
    for roles, val in branches:
        if roles is None:
            return val if expr is None else expr.otherwise(val)
        cond = col_(role).isin(*roles)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def mask_transcript(c, role, sector_chars: int = 200, other_chars: int = 100) -> Column:
    v = col_(c)
    sector = F.concat(F.left(v, F.lit(sector_chars)), F.lit("... [REDACTED - "),
                      F.length(v).cast("string"), F.lit(" total characters]"))
    other = F.concat(F.left(v, F.lit(other_chars)),
                     F.lit("... [REDACTED - Contact administrator for full access]"))
    return _choose(role, [(FULL_TEXT_ROLES, v), (SECTOR_ROLES, sector), (None, other)])


def sentiment_bucket(c) -> Column:
    v = col_(c)
    return (F.when(v > 0.5, 0.75).when(v > 0.0, 0.25).when(v > -0.5, -0.25)
            .otherwise(-0.75).cast("double"))


def mask_sentiment(c, role) -> Column:
    """Exact for analysts; otherwise 4 buckets (NULL falls to -0.75)."""
    return _choose(role, [(EXACT_SCORE_ROLES, col_(c).cast("double")), (None, sentiment_bucket(c))])


def mask_embedding(c, role, dim: int = 5) -> Column:
    zeros = F.array_repeat(F.lit(0.0), dim)
    return _choose(role, [(VECTOR_ROLES, col_(c)), (None, zeros)])


def mask_file_size(c, role) -> Column:
    rounded = (half_up(col_(c).cast("double") / 10.0, 0) * 10.0).cast("bigint")
    return _choose(role, [((ADMIN,), col_(c).cast("bigint")), (None, rounded)])


def role_tickers_frame(spark: SparkSession, mapping: dict | None = None) -> DataFrame:
    mapping = ROLE_TICKERS if mapping is None else mapping
    rows = [(r, t) for r, ts in mapping.items() for t in ts]
    return spark.createDataFrame(rows, "role string, ticker string")


def row_access(df: DataFrame, role: str, role_tickers: DataFrame | None = None,
               col: str = "ticker") -> DataFrame:
    """Rows visible to ``role``: everything for privileged roles, the
    role's ticker list for sector roles, nothing otherwise.

    The role->ticker table is the policy definition; the optimiser decides
    by its size whether it is broadcast.
    """
    if role in ALL_ROWS_ROLES:
        return df
    rt = role_tickers if role_tickers is not None else role_tickers_frame(df.sparkSession)
    allowed = rt.filter(F.col("role") == role).select(F.col("ticker").alias("_allowed"))
    return df.join(allowed, df[col] == F.col("_allowed"), "left_semi")


# Policies attached per table: (row filter column or None, {column: mask}).
ATTACHED = {
    "stg_earnings_calls": ("ticker", {"transcript_text": mask_transcript}),
    "int_earnings_sentiment": (None, {"transcript_text": mask_transcript}),
    "mart_earnings_summary": ("ticker", {"sentiment_score": mask_sentiment}),
    "mart_research_signals": ("ticker", {"ceo_sentiment": mask_sentiment}),
    "mart_filing_dashboard": ("ticker", {}),
    "ml_filing_embeddings": (None, {"embedding_vector": mask_embedding}),
    "earnings_calls": ("ticker", {}),
    "sec_filings": ("ticker", {}),
    "stock_prices": ("ticker", {}),
}


def secure_view(df: DataFrame, table: str, role: str, role_tickers: DataFrame | None = None,
                attached: dict | None = None) -> DataFrame:
    """Apply the table's policies for ``role``: row filter first, then masks."""
    row_col, masks = (attached or ATTACHED).get(table, (None, {}))
    out = row_access(df, role, role_tickers, row_col) if row_col else df
    if masks:
        out = out.withColumns({c: fn(F.col(c), role) for c, fn in masks.items() if c in out.columns})
    return out


def per_role(df: DataFrame, roles: Sequence[str] = ROLES, role_tickers: DataFrame | None = None, col: str | None = None) -> DataFrame:
    """Every row once for each role that may see it, from one derivation of
    ``df``: rows are joined with the (role, ticker) policy instead of being
    derived anew per role. ``col`` None: no row filter."""
    role = lambda names: F.explode(F.array(*[F.lit(r) for r in names])) if names else F.explode(F.array().cast("array<string>"))
    if col is None:
        return df.withColumn("role", role(list(roles)))
    rt = role_tickers if role_tickers is not None else role_tickers_frame(df.sparkSession)
    listed = [r for r in roles if r not in ALL_ROWS_ROLES]
    allowed = (rt.filter(F.col("role").isin(listed)).groupBy(F.col("ticker").alias("_allowed"))
               .agg(F.collect_set("role").alias("_roles")))               # a row per ticker of the policy
    everyone = F.array(*[F.lit(r) for r in roles if r in ALL_ROWS_ROLES]).cast("array<string>")
    joined = df.join(allowed, df[col] == F.col("_allowed"), "left")
    return joined.withColumn("role", F.explode(F.concat(everyone, F.coalesce("_roles", F.array().cast("array<string>"))))).drop("_allowed", "_roles")


def secure_view_roles(df: DataFrame, table: str, roles: Sequence[str] = ROLES, role_tickers: DataFrame | None = None,
                      attached: dict | None = None) -> DataFrame:
    """``secure_view`` for many roles at once, with the role as a column."""
    row_col, masks = (attached or ATTACHED).get(table, (None, {}))
    out = per_role(df, roles, role_tickers, row_col)
    return out.withColumns({c: fn(F.col(c), F.col("role")) for c, fn in masks.items() if c in out.columns}) if masks else out
