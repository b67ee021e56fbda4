"""Every registered query against its DuckDB oracle on sf0.001; queries
without an oracle must at least run and keep a stable schema."""

import duckdb
import pytest

import __spark_entry__ as se
from tessera import catalog
from tessera.sources.tables import TABLE_NAMES, table_path
from tools.oracle_check import digest

KEYS = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def duck(small_dir):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(small_dir, t)}')")
    return con


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(se.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, small_dir, key):
    df = se.queries()[key](spark, small_dir)
    rows = [tuple(r) for r in df.collect()]
    sql = se.oracle_sql().get(key)
    if sql is None:
        assert rows
        return
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0 and len(df.columns) == 25
