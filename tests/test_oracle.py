"""Every registered query against its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sensorflow.plans.catalog import ORACLE, QUERIES

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    import pandas as pd
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object)
    pdf = pdf.where(pd.notna(pdf), None)
    rows = [tuple(_norm(x) for x in r) for r in pdf.itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "if_movement" in df.columns


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    sql = ORACLE.get(name)
    if sql is None:
        pytest.skip("rows-only query")
    ddf = duck.execute(sql).df()
    sc, sr = _rows(sdf)
    dc, dr = _rows(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
