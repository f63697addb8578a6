"""Queries against their SQL at the smallest scale."""

import os

import duckdb
import pytest

from shelfmark.queries import ORACLE_SQL, QUERIES, flagship

def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    fix = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(repr(tuple(fix(r[k]) for k in order)) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name in ORACLE_SQL:
        want = duck.sql(ORACLE_SQL[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert canon([tuple(r) for r in rows], df.columns) == canon(want.fetchall(), want.columns)
    else:
        assert len(rows) > 0


def test_flagship_has_rows(spark, sf_dir):
    assert flagship(spark, sf_dir).count() > 0
