"""Every query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from spanroute import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_small):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_small}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return repr(v) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, sf_small, name):
    df = plans.QUERIES[name](spark, sf_small)
    rows = df.collect()
    if name not in plans.ORACLES:
        assert rows and len(set(df.columns)) == len(df.columns)
        return
    result = duck.execute(plans.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in df.columns) for r in result.fetchall())
    assert sorted(tuple(map(plain, r)) for r in rows) == want
