"""Queries of this subpackage that have SQL, against it, on the smallest tables."""

import duckdb
import pytest

from loomspark.llm import registry

from ..test_queries import SF, normal


@pytest.mark.skipif(not SF.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert normal(registry.QUERIES[name](spark, str(SF)).toPandas()) == normal(c.sql(registry.SQL[name]).df())
