"""Every registered query against its SQL equivalent on the same tables."""

import datetime
import os
import time

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA

SF = os.environ.get("TABKIT_SF", "0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    start = time.time()
    df = QUERIES[name](spark, f"{DATA}/sf{SF}")
    got = df.collect()
    print(f"{name}: {len(got)} rows, {time.time() - start:.1f}s")
    if name not in ORACLES:
        assert got
        return
    rel = duck.sql(ORACLES[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    odd = {c: (t, theirs[c]) for c, t in df.dtypes if t in kinds and kinds[t] != theirs[c]}
    assert not odd, f"types differ: {odd}"
    a, b = table_of(df.columns, got), table_of(rel.columns, want)
    assert len(a) == len(b)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    assert not bad, f"{len(bad)} of {len(a)} rows differ, e.g. {bad[:3]}"


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
