"""Every query against its SQL oracle in DuckDB, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

from loomspark import queries

SF = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(df):
    df = df[sorted(df.columns)]
    rows = [tuple(None if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in df.itertuples(index=False)]
    return list(df.columns), sorted(rows, key=repr)


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not SF.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, str(SF)).toPandas()
    assert normal(got) == normal(duck.sql(queries.SQL[name]).df())


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    if SF.exists():
        assert e.entry(spark).count() > 0
