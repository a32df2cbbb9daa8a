"""Queries that SQL can express, against their SQL on DuckDB."""

import duckdb
import pytest

from regioncast.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import SF

TABLES = ("documents", "benchmark", "labels")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in res.description]
    got = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, res.fetchall()))
