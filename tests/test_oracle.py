"""Every registered query against its DuckDB oracle at sf0.001 (rows, columns,
values; floats are compared exactly because the SQL is written to produce
bit-identical doubles)."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem documents pages".split()


def _norm(df):
    df = df[sorted(df.columns)]
    rows = []
    for r in df.itertuples(index=False):
        rows.append(tuple(None if (v is None or v is pd.NA or (isinstance(v, float) and v != v))
                          else (v.item() if hasattr(v, "item") and not isinstance(v, str) else v)
                          for v in r))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split():
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    from pixtrend.plans.registry import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - set(E.EXTRA_ORACLE)))
def test_query_matches_oracle(spark, duck, name):
    s = E.queries()[name](spark, SF).toPandas()
    d = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _norm(s) == _norm(d)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["x", "y"]
