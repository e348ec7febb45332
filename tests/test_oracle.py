"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the entry() smoke check at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from quaestor.plans import catalog
from tools_oracle import norm

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["tax_type_code", "year_quarter"]


def test_every_warehouse_query_has_oracle():
    catalog.load_all()
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF01)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(srows) == len(drows)
    o = sorted(range(len(cols)), key=lambda i: cols[i])
    od = sorted(range(len(dcols)), key=lambda i: dcols[i])
    assert sorted(tuple(norm(r[i]) for i in o) for r in srows) == sorted(tuple(norm(r[i]) for i in od) for r in drows)
