"""Every query against its SQL counterpart on the smallest data set."""

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from lakeweave.catalog import oracle, queries

from conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        return None if math.isnan(value) else round(float(value), 9)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, date) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_counterpart_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert rows
        return
    result = duck.execute(ORACLE[name])
    assert table(df.columns, rows) == table([c[0] for c in result.description], result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 40
