"""Every registered core query against its SQL, on the smallest tables."""

import datetime as dt
import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def _cell(v):
    return v.replace(tzinfo=None).isoformat() if isinstance(v, dt.datetime) else repr(v + 0.0) if isinstance(v, float) else repr(v)


def _names():
    from quarryweave.queries import corpus, graphs, projections, records, references

    return [(m, n) for m in (corpus, graphs, projections, records, references) for n in m.QUERIES]


def compare(spark, module, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    df = module.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(_cell(r[c]) for c in columns) for r in df.collect())
    if name not in module.ORACLE_SQL:
        return
    result = con.sql(module.ORACLE_SQL[name])
    order = [result.columns.index(c) for c in columns]
    assert sorted(result.columns) == columns
    assert got == sorted(tuple(_cell(r[i]) for i in order) for r in result.fetchall())


@pytest.mark.parametrize("module, name", _names(), ids=lambda x: x if isinstance(x, str) else "")
def test_query(spark, module, name):
    compare(spark, module, name)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
