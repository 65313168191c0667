"""Registered queries against their DuckDB SQL on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from reelsim.plans.catalogue import QUERIES
from reelsim.sources.tables import TABLES


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())


def test_entry_smoke(spark):
    out = E.entry(spark).collect()
    assert len(out) == 5
    assert [r["rank"] for r in sorted(out, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]
