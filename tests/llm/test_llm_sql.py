"""The operators that SQL can tell, against it."""

from pathlib import Path

import duckdb
import pytest

from quillrank.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = LLM_QUERIES[name](spark, SF)
    found = duck.execute(LLM_ORACLES[name])
    columns = [column[0] for column in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(found.fetchall())
