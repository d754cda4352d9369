"""Every query with SQL against DuckDB on the smallest tables; the others run."""

import datetime
import math
import os

import duckdb
import pytest

from corpuscle.plans import queries as plans

SF = "/root/testdata/sf0.001"
SQL = plans.oracle_sql()


def norm(v):
    if isinstance(v, float):
        return "None" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, int) and not isinstance(v, bool):
        return f"{v:.6g}" if abs(v) < 1e6 else str(v)
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        path = f"{SF}/{f}/*.parquet" if os.path.isdir(f"{SF}/{f}") else f"{SF}/{f}"
        if f.endswith(".parquet"):
            c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{path}')")
    return c


@pytest.mark.parametrize("name", list(plans.queries()))
def test_query(spark, con, name):
    df = plans.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted("|".join(norm(r[c]) for c in columns) for r in df.collect())
    if name not in SQL:
        return
    cur = con.execute(SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    assert got == sorted("|".join(norm(r[names.index(c)]) for c in columns) for r in cur.fetchall())
