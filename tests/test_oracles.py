"""Every catalog query against its DuckDB oracle on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from cdclake.plans.catalog import QUERIES
from cdclake.plans.oracles import ORACLES
from tests.conftest import SF_SMALL
from tools.compare_oracles import TABLES, _rows


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_oracles_use_only_the_registered_views():
    for name, sql in ORACLES.items():
        assert "read_parquet" not in sql and "/root" not in sql and ".parquet" not in sql, name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _rows(s_cols, s_rows) == _rows(o_cols, o_rows)


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 28
    assert df.count() > 0
