"""Driver contract: entry() runs, and every query with an oracle matches
DuckDB on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "average_score_dynamic" in df.columns


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, con, name):
    s = digest(entry.queries()[name](spark, SF).toPandas())
    o = digest(con.sql(entry.oracle_sql()[name]).df())
    assert s[0] == o[0]
    assert s[1] == o[1]
    assert s[2] == o[2]
