"""Queries of the operators that SQL can express, against it."""

import duckdb
import pytest
from edge_cases import SF

from predial.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    theirs = db.execute(queries.ORACLES[name])
    names = [d[0] for d in theirs.description]
    want = sorted(map(str, theirs.fetchall()))
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == want
