"""Every registered query against its SQL oracle on the smallest data set
(the driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from lookout.plans.queries import QUERIES
from lookout.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.execute(SQL[name]).df()
    assert _rows(got) == _rows(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "doc_id", "name", "address", "description", "website", "score", "rank"]
    assert df.count() > 0
