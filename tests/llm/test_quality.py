"""The classifier: held-out accuracy, what it must not see, and odd rows."""

import zlib

import numpy as np
import pytest
from llm_rows import read_rows

from quillrank.llm import quality
from quillrank.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scores(spark):
    return {r.doc_id: r for r in LLM_QUERIES["op5_quality"](spark, SF).collect()}


def test_held_out_accuracy(scores):
    labels = dict(read_rows(SF, "labels", ["doc_id", "quality"]))
    held = [doc for doc in labels if zlib.crc32(str(doc).encode()) % 5 == 0]
    assert all(scores[doc].held_out == (zlib.crc32(str(doc).encode()) % 5 == 0) for doc in scores)
    right = [scores[doc].predicted == labels[doc] for doc in held]
    assert len(held) > 50 and np.mean(right) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scores.values())
    assert len(scores) == 1000


def test_held_out_labels_do_not_matter(spark, scratch):
    documents = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("doc_id < 300")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    one, other = quality.fit(documents, labels, scratch), quality.fit(documents, turned, scratch)
    assert all((a == b).all() for a, b in zip(one.layers, other.layers, strict=True)) and one.temperature == other.temperature


def test_odd_rows(spark, scratch, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, None), (3, 0), (None, 1), (7, 1), (9, 0), (10, 0), (99, 1), (4, 5)], "doc_id bigint, quality int"
    )
    model = quality.fit(odd_documents, labels, scratch)
    found = quality.scored(odd_documents, model)
    assert set(found.columns) == set(odd_documents.columns)
    rows = found.collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if not r.text}
    assert len(empty) == 1
    assert quality.scored(no_documents, model).isEmpty()


def test_one_class_or_none(spark, scratch, odd_documents, no_documents):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int")
    assert quality.fit(no_documents, labels([]), scratch).prior == 0.5
    model = quality.fit(odd_documents, labels([(i, 1) for i in range(9)]), scratch)
    assert {r.score for r in quality.scored(odd_documents, model).collect()} == {1.0}


def test_context_sums_are_sums_of_index_vectors():
    text = "a b c b ! a"
    places, signs = quality.index_entries()
    index = np.zeros((quality.WORDS, quality.DIM), dtype=int)
    for i in range(quality.NONZERO):
        np.add.at(index, (np.arange(quality.WORDS), places[:, i]), signs[:, i])
    numbers = (quality.words(text) % np.uint64(quality.WORDS)).astype(int)
    wanted = np.zeros_like(index)
    for i, n in enumerate(numbers):
        for j in range(max(0, i - quality.WINDOW), min(len(numbers), i + quality.WINDOW + 1)):
            if i != j:
                wanted[n] += index[numbers[j]]
    assert (quality.context_sums(iter([text, None, ""])).reshape(wanted.shape) == wanted).all()
    assert len(quality.words("Ab, cd!! e1\n")) == 6


def test_word_vectors_come_from_all_documents(spark, scratch, monkeypatch):
    """A word that no labelled document holds has the vector of its own contexts, which no other word shares."""
    texts = ["red green blue red", "unseen words stand here", "unseen words stay", None, ""]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1)], "doc_id bigint, quality int")
    vectors = quality.fit(documents, labels, scratch).vectors
    distinct = np.unique(np.concatenate([quality.words(t) for t in texts]))
    assert (vectors.own == distinct).all() and not vectors.rows[: quality.WORDS].any()
    index = quality._index_table()[(quality.words("words stand words stay") % np.uint64(quality.WORDS)).astype(int)].astype(int)
    wanted = index.sum(axis=0)
    found = vectors.rows[quality.WORDS + np.searchsorted(vectors.own, quality.words("unseen"))[0]]
    assert np.allclose(found, wanted / max(np.linalg.norm(wanted), 1), atol=1e-6)
    # Words under one in two share by hash.
    monkeypatch.setattr(quality, "OWN_VECTOR", 2)
    few = quality.word_vectors(spark.createDataFrame([(1, "a a a b"), (2, "c a")], "doc_id bigint, text string"), scratch)
    assert (few.own == quality.words("a")).all() and few.rows[quality.words("b")[0] % quality.WORDS].any()


def test_chunks_do_not_change_sums(monkeypatch):
    text = "a b c b ! a d e f a b " * 5
    whole = quality.context_sums(iter([text, "x y"]), np.sort(quality.words("a b")))
    monkeypatch.setattr(quality, "_CHUNK", 3)
    assert (quality.context_sums(iter([text, "x y"]), np.sort(quality.words("a b"))) == whole).all()


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(2)
    y = (rng.random(4000) < 0.5).astype(float)
    logits = (y * 2 - 1) + rng.normal(0, 1, 4000)
    assert abs(quality._temperature(logits * 3, y) / quality._temperature(logits * 1.5, y) - 2) < 0.2
