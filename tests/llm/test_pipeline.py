"""The pipeline: what every stage keeps, judged on its own input."""

import pytest
from llm_rows import documents, read_rows
from test_copies import near_by_brute_force
from test_pii import SECRET

import corpus_pipeline
from quillrank.llm import quality
from quillrank.storage import Scratch, checkpointed

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after every stage, the given documents first."""
    with Scratch(spark) as scratch:
        docs = documents(spark, SF)
        found = [docs.collect()]
        for _, stage in corpus_pipeline.STAGES:
            docs = scratch.stored(stage(spark, docs, SF))
            found.append(docs.collect())
        yield found


def test_names_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "MinHash near-dedup", "PII", "packing",
    ]
    assert all(set(rows[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"} for rows in steps[:-1])


def test_rejected_documents_go_and_good_ones_stay(steps):
    labels = dict(read_rows(SF, "labels", ["doc_id", "quality"]))
    kept = {r.doc_id for r in steps[1]}
    assert sum(labels[d] != (d in kept) for d in labels) <= 0.02 * len(labels)


def test_one_of_equal_texts_stays(steps):
    last = {}
    for r in steps[1]:
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert sorted(r.doc_id for r in steps[2]) == sorted(last.values())


def test_one_of_near_copies_stays(steps):
    wanted = near_by_brute_force([(r.doc_id, r.text) for r in steps[2]], 80)
    assert sorted(r.doc_id for r in steps[3]) == sorted(doc for doc, (_, _, kept) in wanted.items() if kept)


def test_secrets_are_exchanged(steps):
    before = {r.doc_id: r for r in steps[3]}
    assert {r.doc_id for r in steps[4]} == set(before)
    for r in steps[4]:
        assert not [x for x in SECRET.findall(before[r.doc_id].text) if x in r.text]
        assert r.n_chars == len(r.text)


def test_all_that_is_left_is_packed(steps):
    assert {r.doc_id for r in steps[5]} == {r.doc_id for r in steps[4]}
    for doc in {r.doc_id for r in steps[5]}:
        own = [r for r in steps[5] if r.doc_id == doc]
        assert sum(r.length for r in own) == own[0].doc_tokens


def test_run_equals_the_stages(spark, steps):
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect()
    assert {tuple(r) for r in rows} == {(r.doc_id, r.doc_tokens) for r in steps[5]}


def test_stages_bear_odd_rows(spark, odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(quality, "fit", lambda *_: quality.Model(*[None] * 3, [], 1.0, 0.9))
    monkeypatch.setattr(quality, "score_of", lambda text, model: corpus_pipeline.F.lit(0.9))
    for docs in (odd_documents, no_documents):
        with Scratch(spark) as scratch:
            for _, stage in corpus_pipeline.STAGES:
                columns = docs.columns
                docs = scratch.stored(stage(spark, docs, SF))
                if stage is not corpus_pipeline.packed:
                    assert docs.columns == columns
            assert docs.isEmpty() == (columns == no_documents.columns and docs.count() == 0)


def test_last_stages_send_short_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, sent = spark.conf.get(name), []
    monkeypatch.setattr(corpus_pipeline, "BATCH_ROWS", 7)
    monkeypatch.setattr(corpus_pipeline, "checkpointed", lambda df: sent.append(spark.conf.get(name)) or checkpointed(df))
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id bigint, text string")
    assert corpus_pipeline.with_surrogates(spark, docs, SF).count() == 20
    assert corpus_pipeline.packed(spark, docs, SF).select("doc_id").distinct().count() == 20
    assert sent == ["7", "7"] and spark.conf.get(name) == before
