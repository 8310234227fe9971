"""The policies as plain SQL: scalar functions, a session variable, views.

``install`` declares the session variable ``app_role`` and one temporary SQL
function per mask; ``create_views`` puts a secure view over every table that
has policies. From then on ``SET VAR app_role = '...'`` and ordinary SQL over
the views give what the role may see. Functions are SQL expressions that the
optimiser inlines: no Python runs, and the role folds to one branch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from . import governance as gov

ROLE = "app_role"


def _names(roles: Sequence[str]) -> str:
    return ", ".join(f"'{r}'" for r in roles)


def functions() -> dict[str, str]:
    """name -> CREATE statement of every mask."""
    other = "'... [REDACTED - Contact administrator for full access]'"
    return {
        "mask_transcript": f"""
            CREATE OR REPLACE TEMPORARY FUNCTION mask_transcript(v STRING, role STRING) RETURNS STRING RETURN
            CASE WHEN role IN ({_names(gov.FULL_TEXT_ROLES)}) THEN v
                 WHEN role IN ({_names(gov.SECTOR_ROLES)})
                   THEN left(v, 200) || '... [REDACTED - ' || CAST(length(v) AS STRING) || ' total characters]'
                 ELSE left(v, 100) || {other} END""",
        "mask_sentiment": f"""
            CREATE OR REPLACE TEMPORARY FUNCTION mask_sentiment(v DOUBLE, role STRING) RETURNS DOUBLE RETURN
            CASE WHEN role IN ({_names(gov.EXACT_SCORE_ROLES)}) THEN v
                 WHEN v > 0.5D THEN 0.75D WHEN v > 0.0D THEN 0.25D WHEN v > -0.5D THEN -0.25D ELSE -0.75D END""",
        "mask_embedding": f"""
            CREATE OR REPLACE TEMPORARY FUNCTION mask_embedding(v ARRAY<DOUBLE>, role STRING) RETURNS ARRAY<DOUBLE> RETURN
            CASE WHEN role IN ({_names(gov.VECTOR_ROLES)}) THEN v ELSE array_repeat(0.0D, 5) END""",
        "mask_file_size": f"""
            CREATE OR REPLACE TEMPORARY FUNCTION mask_file_size(v BIGINT, role STRING) RETURNS BIGINT RETURN
            CASE WHEN role = '{gov.ADMIN}' THEN v ELSE CAST(floor(v / 10.0D + 0.5D) * 10 AS BIGINT) END""",
    }


#: Which function masks which column (the functions of ``governance.ATTACHED``).
MASKS = {gov.mask_transcript: "mask_transcript", gov.mask_sentiment: "mask_sentiment", gov.mask_embedding: "mask_embedding",
         gov.mask_file_size: "mask_file_size"}


def install(spark: SparkSession, role_tickers: DataFrame | None = None) -> None:
    """The session variable, the functions, and the policy table ``role_tickers``."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT 'PUBLIC'")
    for create in functions().values():
        spark.sql(create)
    (role_tickers if role_tickers is not None else gov.role_tickers_frame(spark)).createOrReplaceTempView("role_tickers")


def set_role(spark: SparkSession, role: str) -> None:
    spark.sql(f"SET VAR {ROLE} = '{role}'")


def view_sql(table: str, columns: Sequence[str], attached: dict | None = None) -> str:
    """CREATE statement of the secure view over ``table``."""
    row_col, masks = (attached or gov.ATTACHED)[table]
    shown = [f"{MASKS[masks[c]]}({c}, session.{ROLE}) AS {c}" if c in masks else c for c in columns]
    seen = ""
    if row_col:
        seen = (f" WHERE session.{ROLE} IN ({_names(gov.ALL_ROWS_ROLES)})"
                f" OR {row_col} IN (SELECT ticker FROM role_tickers r WHERE r.role = session.{ROLE})")
    return f"CREATE OR REPLACE TEMPORARY VIEW secure_{table} AS SELECT {', '.join(shown)} FROM base_{table}{seen}"


def create_views(spark: SparkSession, tables: dict[str, DataFrame], attached: dict | None = None) -> list[str]:
    """Secure views of the tables that have policies; their names."""
    out = []
    for table, df in tables.items():
        df.createOrReplaceTempView(f"base_{table}")
        spark.sql(view_sql(table, df.columns, attached))
        out.append(f"secure_{table}")
    return out
