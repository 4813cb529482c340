import os

import pytest

import __spark_entry__
from pairloom.plans import catalog

SMALL = "/root/testdata/sf0.001"


def test_every_stated_result_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    ours = catalog.queries()[name](spark, SMALL)
    result = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(ours.columns)

    def plain(v):
        return float(f"{float(v):.9g}") if isinstance(v, float) or type(v).__name__ == "Decimal" else v

    def rows(data):
        return sorted((tuple(plain(v) for v in r) for r in data), key=repr)

    mine = rows(tuple(r[n] for n in names) for r in ours.collect())
    theirs = rows(result.fetchall())
    assert [tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r) for r in mine] == [
        tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r) for r in theirs
    ]
