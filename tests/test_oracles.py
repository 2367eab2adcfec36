"""Every registered query against its DuckDB oracle on the smallest driver tables, plus the
driver contract (entry, names, column agreement)."""

import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 50


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = _rows(queries()[name](spark, SMALL).toPandas())
    exp = _rows(con.execute(oracle_sql()[name]).df())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = queries()[name](spark, SMALL)
    assert df.columns and df.count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["call_id", "instruction", "request", "answer"]
    assert df.count() > 0
