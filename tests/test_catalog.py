from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n in entry.catalog.QUERIES))
def test_query_is_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name in entry.oracle_sql():
        result = duck.execute(entry.oracle_sql()[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == columns
        want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
        assert got == want
    else:
        assert got


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.exists(DATA)
