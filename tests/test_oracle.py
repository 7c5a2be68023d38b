"""Every registered query against its DuckDB oracle on sf0.001 (exact values)."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF0001

TABLES = ["part", "lineitem", "orders"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(se._own_queries()) - set(se._own_oracle_sql())
    assert not rows_only
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(se._own_oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF0001)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert _norm(srows, scols) == _norm(drows, dcols)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["list_name", "value", "rank", "item_id", "title", "rating_count", "avg_rating"]
