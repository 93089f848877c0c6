"""Every registered query equals its independent DuckDB SQL (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from airloom.plans import registry
from tools.check_oracle import TABLES, digest, rows_of

SF_DIR = os.environ.get("AIRLOOM_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_DIR}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    missing = set(KEYS) - set(E.oracle_sql())
    assert missing == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "country", "reading_date", "avg_pm25", "reading_count"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_DIR)
    s_rows = rows_of(df.columns, df.collect())
    res = con.execute(E.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_rows) == digest(d_rows)
