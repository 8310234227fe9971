"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01; set TIDEMARK_PARITY_SF to a
driver folder, e.g. /root/testdata/sf0.01, to run it there)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from helpers import SF_SMALL as _DEFAULT_SF  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SF_SMALL = os.environ.get("TIDEMARK_PARITY_SF", _DEFAULT_SF)
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "composite_signal_score" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sp) >= 0
        return
    dk = duck.execute(sql).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
