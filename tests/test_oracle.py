"""Every registered query with a SQL twin gives the same rows as DuckDB."""

import math

import duckdb
import pytest

from saltmarsh.plans import ORACLES, QUERIES
from saltmarsh.sources import TABLES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v)
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rel = con.sql(ORACLES[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())
