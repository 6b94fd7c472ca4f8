"""The registered queries on the smallest tables; with SQL against DuckDB."""

import os

import duckdb
import pytest

from cdclake.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF_SMALL}/documents.parquet"), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    found = QUERIES[name](spark, SF_SMALL)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r)) for r in found.select(*names).collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_per_row_of_the_table(spark, name):
    other = {"op1_multiprobe_ann": None, "op10_html_extraction": "pages", "op11_vector_codes": "embeddings", "op12_whitening": "embeddings"}
    table = other.get(name, "documents")
    each = 32 if name == "op12_whitening" else 1  # components of a vector
    found = QUERIES[name](spark, SF_SMALL)
    if table:
        key = found.columns[0]
        given = spark.read.parquet(f"{SF_SMALL}/{table}.parquet")
        assert sorted(r[0] for r in found.select(key).collect()) == sorted(r[0] for r in given.select(key).collect() for _ in range(each))
    else:
        ids = [r.vec_id for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").where("vec_id % 100 = 0").collect()]
        assert found.count() == 10 * len(ids)
