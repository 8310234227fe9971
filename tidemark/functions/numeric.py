"""Numeric column helpers shared by all operators.

Rounding is half away from zero computed with plain IEEE arithmetic
(``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``) so that the value is the same
bit pattern in Spark and in any SQL engine used as an oracle. The floor is
taken in double arithmetic (no 64-bit integer in between), and a value whose
scaled size is beyond 2^52 has no digits to round and is returned as it is.
A decimal tie such as 1.005 is judged by its binary value (1.0, not 1.01).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(c, digits: int) -> Column:
    """ROUND(x, digits) with half-away-from-zero ties, NULL-preserving."""
    x = col_(c).cast("double")
    scale = float(10 ** digits)
    y = F.abs(x) * F.lit(scale) + F.lit(0.5)
    return F.when(y < F.lit(2.0 ** 52), F.signum(x) * (y - y % F.lit(1.0)) / F.lit(scale)).otherwise(x)


def safe_div(num, den) -> Column:
    """num / NULLIF(den, 0): NULL instead of a division error (ANSI mode)."""
    d = col_(den)
    return col_(num) / F.when(d != 0, d)


def pct(part, whole, digits: int) -> Column:
    """ROUND(part * 100.0 / whole, digits) in double arithmetic."""
    return half_up(safe_div(col_(part).cast("double") * F.lit(100.0), col_(whole)), digits)
