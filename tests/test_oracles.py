"""Every query with an oracle: Spark result == DuckDB result on sf0.001."""

import hashlib
import math

import duckdb
import pytest

from kestrel.plans.registry import all_queries
from kestrel.sources.tables import TABLES

from testdata_paths import SF_SMALL

QUERIES = {n: q for n, q in all_queries().items() if q.oracle}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        r = round(v, 6)
        return repr(0.0 if r == 0 else r)
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    q = QUERIES[name]
    df = q.build(spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(q.oracle)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
