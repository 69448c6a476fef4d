"""The driver contract on the smallest tables, checked against SQL where the tables are at hand."""

import glob
import os
from collections import Counter

import pytest

import __spark_entry__ as spark_entry
from workload.queries import ALL

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


def normal(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def bag(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view \"{name}\" as select * from '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(ALL) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    frame = spark_entry.queries()[name](spark, DATA)
    result = sql.execute(spark_entry.oracle_sql()[name])
    expected = bag([c[0] for c in result.description], result.fetchall())
    assert bag(frame.columns, frame.collect()) == expected
