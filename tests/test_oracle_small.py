"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

from scripts.oracle_check import compare
from tests.conftest import SF001
from tidemark import oracle, queries
from tidemark.sources.fixtures import BASE_TABLES

QUERIES = queries.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == {"inventory_files"} and set(ORACLE) <= set(QUERIES)  # SQL does not see the files


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    s = QUERIES[key](spark, SF001).toArrow()
    d = con.sql(ORACLE[key]).to_arrow_table()
    assert compare(key, s, d) == []
