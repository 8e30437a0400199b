import duckdb
import pytest

import __spark_entry__ as entry
from scripts.oracle_check import TABLES, _digest, vacuous

LIBRARY = entry.catalog_queries()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "demand_risk_tier" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(k for k in entry.oracle_sql() if k in LIBRARY))
def test_oracle_match_small(spark, sf_small, con, key):
    df = LIBRARY[key](spark, sf_small)
    res = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(ocols) == sorted(df.columns)
    assert not vacuous(srows, df.columns)
    idx = [ocols.index(c) for c in df.columns]
    orows = [tuple(r[i] for i in idx) for r in orows]
    assert _digest(srows, df.columns, None)[0] == _digest(orows, df.columns, None)[0]
