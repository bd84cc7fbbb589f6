"""Every query with a DuckDB twin gives the twin's rows."""

import math

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from tidewright import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


def rows(found, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    other = duck.execute(core.oracle_sql()[name])
    columns = [c[0] for c in other.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(other.fetchall(), columns)


def test_every_core_query_has_a_twin():
    assert set(core.queries()) == set(core.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
