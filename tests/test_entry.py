"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from lexspark.plans.catalog import QUERIES
from lexspark.plans.oracles import ORACLES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.queries()) >= set(QUERIES) and set(contract.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = contract.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    answer = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = ordered([tuple(row[i] for i in places) for row in answer.fetchall()])
    got = ordered([tuple(row[c] for c in columns) for row in result.collect()])
    assert got == want


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
