"""The permutation and the law of the shards."""

import zlib

import pytest
from llm_rows import read_rows
from pyspark.sql import functions as F

from quillrank.llm import sharding
from quillrank.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 1000, 4160, 10_007])
def test_permutation(spark, n):
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 1).alias("to")).collect()
    assert sorted(r.to for r in rows) == list(range(n))
    if n > 50:
        assert sum(r.to == r.id for r in rows) < n / 10
        other = spark.range(n).select(sharding.permuted(F.col("id"), n, 2).alias("to")).collect()
        assert [r.to for r in rows] != [r.to for r in other]


def test_query_follows_its_law(spark):
    rows = LLM_QUERIES["op6_feistel_shards"](spark, SF).collect()
    texts = dict(read_rows(SF, "documents"))
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(40))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {r.doc_id: (r.shard, r.slot) for r in LLM_QUERIES["op6_feistel_shards"](spark, SF).collect()} == {
        r.doc_id: (r.shard, r.slot) for r in rows
    }


def test_odd_rows(spark, scratch, odd_documents, no_documents):
    rows = sharding.shard(odd_documents, scratch, shards=4).collect()
    assert sorted(r.permuted for r in rows) == list(range(odd_documents.count()))
    assert {r["size"] for r in rows if r.doc_id == 5} == {16}
    assert sharding.shard(no_documents, scratch, shards=4).isEmpty()


def test_no_python_in_the_plan(spark, scratch, odd_documents):
    plan = sharding.shard(odd_documents, scratch, shards=4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
