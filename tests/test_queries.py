"""Every registered query of the core runs on the smallest tables, and equals its SQL where it has one."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from lodestrata.plans import registry

SF = "/root/testdata/sf0.001"
CORE = {k for m in registry.MODULES for k in m.queries()}
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


def canon(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(canon, v))
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(map(canon, r)) for r in df.select(*cols).collect()), key=repr)
    if name in SQL:
        r = con.execute(SQL[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == cols
        want = sorted((tuple(canon(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
        assert rows == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
