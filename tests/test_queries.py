"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
import check


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    res = con.execute(sql)
    types = {d[0]: str(d[1]) for d in res.description}
    assert {c: check.KINDS.get(t, t) for c, t in df.dtypes} == types
    assert check.rows(df.columns, got) == check.rows([d[0] for d in res.description], res.fetchall())


def test_entry(spark):
    assert E.entry(spark).count() > 0
