"""Every registered batch query equals its DuckDB oracle on sf0.001 (the
driver's gate runs the same comparison at sf0.01 via tools/check_oracle.py,
streaming forms included)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from eventlens.plans import catalog
from eventlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def _norm(rows):
    def v(x):
        return round(x, 6) if isinstance(x, float) and not math.isnan(x) else x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("stream_")))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    expect = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _norm(df.collect()) == _norm(expect)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.ORACLE) <= set(entry.oracle_sql())
