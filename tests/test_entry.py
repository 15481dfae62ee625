import os

import duckdb
import pytest

from .conftest import SF001

import __spark_entry__ as E

from healthmart import queries as Q

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["company_name", "total_profit"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 40
    assert set(Q.REGISTRY) <= set(q)


def test_registry_stands_without_the_training_data_operators(monkeypatch):
    monkeypatch.setattr(E, "L", None)
    assert set(E.queries()) == set(Q.REGISTRY)
    assert set(E.oracle_sql()) <= set(Q.REGISTRY)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF001}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _nullsafe(t):
    return tuple((x is None, str(x)) for x in t)


@pytest.mark.parametrize("name", sorted(n for n, q in Q.REGISTRY.items() if q.sql is not None))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=_nullsafe)
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=_nullsafe)
    assert got == want
