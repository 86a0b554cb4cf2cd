"""Exact and near copies against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_rows import documents, read_rows

from quillrank.llm import exactdedup, oddsketch
from quillrank.llm.cuckoo import CuckooIndex
from quillrank.llm.graph import components
from quillrank.llm.queries import LLM_QUERIES
from quillrank.llm.words import SEGMENT, segments, set_key, shingles, word_hashes

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_by_brute_force(rows, percent):
    sets = {doc: shingle_set(text) for doc, text in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {doc: (len(sets[doc]), root, doc == root) for doc, root in roots(sets, links).items()}


def found_near(spark_rows):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in spark_rows}


# Exact copies.


def test_cuckoo_index_against_a_dictionary():
    rng = random.Random(3)
    index, model = CuckooIndex(buckets=2), {}
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for step in range(20_000):
        digest = rng.choice(digests)
        if rng.random() < 0.6:
            index.put(digest, step)
            model[digest] = step
        else:
            assert index.delete(digest) == (model.pop(digest, None) is not None)
        assert len(index) == len(model)
    assert dict(index.items()) == model
    assert all(index.get(d) == model.get(d) for d in digests)


def test_cuckoo_hits_with_one_fingerprint_are_verified():
    index = CuckooIndex()
    first = bytes(32)
    others = [bytes(18) + i.to_bytes(14, "big") for i in range(1, 30)]  # same fingerprint, same buckets
    index.put(first, "first")
    assert index.get(others[0]) is None
    for i, digest in enumerate(others):
        index.put(digest, i)
    assert index.get(first) == "first" and [index.get(d) for d in others] == list(range(29))


def test_cuckoo_table_grows_with_its_digests_only():
    index = CuckooIndex()
    for i in range(5000):
        index.put(i.to_bytes(4, "little") + bytes(28), i)  # one fingerprint and one pair of buckets for all
    assert len(index) == 5000 and index.get((77).to_bytes(4, "little") + bytes(28)) == 77
    assert len(index._table) * 4 <= 4 * 5000
    assert all(index.delete(i.to_bytes(4, "little") + bytes(28)) for i in range(0, 5000, 2))
    assert dict(index.items()) == {i.to_bytes(4, "little") + bytes(28): i for i in range(1, 5000, 2)}


def test_updates_of_a_living_index(spark):
    digest = lambda i: hashlib.sha256(str(i).encode()).digest()
    fields = "digest binary, keep_id bigint"
    live = spark.createDataFrame([(digest(1), 5, 2), (digest(2), 7, 1), (digest(3), 9, 4)], f"{fields}, copies bigint")
    deleted = spark.createDataFrame([(digest(1), 5), (digest(2), 7), (digest(8), 1), (None, 2)], fields)
    inserted = spark.createDataFrame([(digest(3), 11), (digest(4), 1), (digest(4), 3), (digest(2), 2)], fields)
    rows = exactdedup.updated(live, inserted, deleted).collect()
    assert {bytes(r.digest): (r.keep_id, r.copies) for r in rows} == {
        digest(1): (5, 1), digest(2): (2, 1), digest(3): (11, 5), digest(4): (3, 2),
    }


def test_exact_groups_of_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    wanted = []
    for doc, text in rows:
        ids = [d for d, t in rows if (t or "") == (text or "")]
        keep = max((d for d in ids if d is not None), default=None)
        wanted.append((doc, keep, len(ids), doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, exactdedup.exact_groups(odd_documents).collect()))) == sorted(map(repr, wanted))


def test_shards_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(exactdedup, "SHARD", 100)
    rows = spark.range(3000).selectExpr("id as doc_id", "cast(id % 1000 as string) as text")
    live = exactdedup.live_digests(rows)
    assert live.rdd.getNumPartitions() >= 10
    assert sorted((r.keep_id, r.copies) for r in live.collect()) == [(i, 3) for i in range(2000, 3000)]


def test_without_copies_keeps_columns(odd_documents, no_documents):
    left = exactdedup.without_copies(odd_documents)
    assert left.columns == odd_documents.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [2, 2, 3, 5, 6, 7, 8, 9, 10, 10]
    assert exactdedup.without_copies(no_documents).isEmpty()
    assert exactdedup.exact_groups(no_documents).isEmpty()


# Near copies.


def test_shingles_are_those_of_the_text():
    for text in ["", " ", "a", "A b", "a\tB  c\nd\x0be f", "x\x1cy z", "é É ß", "w " * 9, "a\x85b c"]:
        assert len(shingles(text)) == len(shingle_set(text)), repr(text)
    assert (word_hashes("The the THE") == word_hashes("the")[0]).all()
    assert set(shingles("a b c d e f g")) & set(shingles("x B C D E f y"))


def test_long_texts_are_hashed_in_segments():
    text = ("word " * 7 + "other\n") * 40_000
    assert len(list(segments(text.encode()))) > 1
    assert (word_hashes(text) == np.tile(word_hashes("word " * 7 + "other"), 40_000)).all()
    assert len(word_hashes("x" * (SEGMENT + 10) + " y")) == 2


@pytest.mark.parametrize("percent", [80, 85])
def test_near_groups_of_documents(spark, scratch, percent):
    found = oddsketch.near_groups(documents(spark, SF), scratch, percent).collect()
    assert found_near(found) == near_by_brute_force(read_rows(SF, "documents"), percent)


def test_odd_sketch_query(spark):
    found = LLM_QUERIES["op10_odd_sketches"](spark, SF).collect()
    assert found_near(found) == near_by_brute_force(read_rows(SF, "documents"), 85)


def edited_copies(groups, copies, words, seed):
    """Chains and stars of copies: each has a few words of another copy of its group exchanged."""
    rng = random.Random(seed)
    rows, number = [], 0
    for _ in range(groups):
        members = [[f"w{rng.randint(0, 10**6)}" for _ in range(words)]]
        for _ in range(copies):
            edited = list(rng.choice(members))
            for _ in range(rng.randint(0, 3)):
                edited[rng.randrange(words)] = f"w{rng.randint(0, 10**6)}"
            members.append(edited)
        for member in members:
            rows.append((number, " ".join(member)))
            number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "seed"), [(120, 1), (60, 2), (9, 3)])
def test_groups_of_edited_copies(spark, scratch, monkeypatch, words, seed):
    monkeypatch.setattr(oddsketch, "BLOCK", 16)
    rows = edited_copies(6, 40, words, seed)
    found = oddsketch.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), scratch, 85).collect()
    assert found_near(found) == near_by_brute_force(rows, 85)


def test_near_groups_of_odd_rows(scratch, odd_documents, no_documents):
    found = oddsketch.near_groups(odd_documents, scratch, 80).collect()
    assert len(found) == odd_documents.count()
    by_id = {}
    for row in found:
        by_id.setdefault(row.doc_id, set()).add((row.component_id, row.kept))
    assert by_id.pop(None) == {(None, True)}
    assert by_id == {
        1: {(1, True)}, 2: {(1, False)}, 3: {(1, False)}, 4: {(4, True)}, 5: {(5, True)}, 6: {(6, True)}, 7: {(7, True)},
        8: {(7, False)}, 9: {(9, True)}, 10: {(10, True)},
    }
    assert oddsketch.near_groups(no_documents, scratch, 80).isEmpty()


def test_texts_of_keys_pass_one_python_worker(spark, odd_documents):
    keys = spark.createDataFrame([(bytearray(set_key(shingles("one two"))),)], "key binary")
    ids = spark.createDataFrame([(7,), (8,), (10,)], "doc_id bigint")
    texts = oddsketch._whole_texts(odd_documents, ids, keys)
    assert texts._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    assert [r.text for r in texts.collect()] == ["ONE  two"]


def test_sketches_of_linked_sets_pass(monkeypatch):
    rng = np.random.default_rng(4)
    for size in (20, 200, 2000):
        for _ in range(60):
            both = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            swapped = int(size * (1 - 0.85) / (1 + 0.85))
            other = np.concatenate((both[swapped:], rng.integers(0, 1 << 63, swapped, dtype=np.uint64)))
            a, b = (oddsketch.odd_sketch(oddsketch.minima(x)) for x in (both, other))
            assert oddsketch._distance(oddsketch._sketches([a]), oddsketch._sketches([b]))[0] <= oddsketch.most_bits(85)


def test_components_of_chains_and_stars(spark, scratch):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 3), (5, 4)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint"), scratch).collect()}
    assert set(found) == {*range(61), *range(100, 140)}
    assert len({found[i] for i in range(61)}) == 1 and len({found[i] for i in range(100, 140)}) == 1
    assert found[0] in range(61) and found[100] in range(100, 140)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), scratch).isEmpty()
