"""Every named query against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from quillrank.plans.oracles import ORACLES
from quillrank.plans.registry import QUERIES

TABLES = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    nan = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted(([nan(row[i]) for i in order] for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, str(TABLES))
    found = duck.execute(ORACLES[name])
    columns = [column[0] for column in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.collect(), df.columns) == comparable(found.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_give_rows(spark, name):
    assert not QUERIES[name](spark, str(TABLES)).isEmpty()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
