"""Every query with SQL gives the rows that DuckDB gives; the others give rows."""

import os

import duckdb
import pytest

from lodeweave.plans import flows as _  # noqa: F401
from lodeweave.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables aren't here")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(r[names.index(c)] for c in sorted(names)) for r in cursor.fetchall()]
    assert sorted(got, key=key) == sorted(want, key=key)
