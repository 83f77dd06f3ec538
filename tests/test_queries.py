from __future__ import annotations

import duckdb
import pytest

import __spark_entry__
from quire.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# needs the state server of streams
STREAMS = {"stream_guard"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) - STREAMS))
def test_query_equals_its_sql(spark, duck, name):
    got = registry.queries()[name](spark, FOLDER)
    said = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in said.description]
    assert sorted(got.columns) == sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in got.columns) for r in said.fetchall())
    assert sorted(tuple(plain(r[c]) for c in got.columns) for r in got.collect()) == want


def test_queries_without_sql_run(spark):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, FOLDER).count() >= 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())
