"""Every registered query against its DuckDB oracle at sf0.001: same row
"""

import hashlib
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from tokenledger.registry import all_queries

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, Decimal):
        return repr(round(float(v), 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["orders", "lineitem"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


QUERIES = sorted(all_queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, df.columns) == _digest(drows, dcols)


def test_every_query_has_an_oracle():
    assert set(all_queries()) <= set(E.queries()) & set(E.oracle_sql())


def test_all_controls_pass(spark):
    rows = E.queries()["control_results"](spark, SF).collect()
    assert len(rows) == 176
    failed = [(r.control_id, r.violation_count) for r in rows if r.status != "PASS"]
    assert failed == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "exception_status" in df.columns
