"""The driver's gate in miniature: every registered query vs its DuckDB oracle at sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from reportlake import conformance
from reportlake.sources.parquet import TEST_TABLES
from conftest import SF

KEYS = sorted(conformance.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TEST_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    want_cols = [c[0] for c in res.description]
    assert sorted(got_cols) == sorted(want_cols)
    assert _rows(got_cols, got) == _rows(want_cols, res.fetchall())
