"""Every evidence query against DuckDB on the smallest tables, and the registry."""

import pandas as pd
import pytest

from caseloom import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(df):
    def value(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        return int(x) if isinstance(x, float) and x.is_integer() else x

    return sorted(repr([value(x) for x in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    if name in queries.ORACLE_SQL:
        want = duck.execute(queries.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)
    else:
        assert len(got)


def test_entry_module(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(queries.QUERIES) <= set(names) and set(entry.oracle_sql()) <= set(names)
    assert entry.entry(spark).count() > 0
