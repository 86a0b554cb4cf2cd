"""Many queries: sums by blocks of articles in numpy, walks with distances by bit vectors, whole rankings by both."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

import model
from builders import article, articles, queries, ranked
from quillrank import Options, rank_documents
from quillrank.functions import adding
from quillrank.functions.walking import Titles, distances
from quillrank.operators import bags, blocks
from quillrank.plans import retrieval
from quillrank.storage import Scratch
from test_ranking import filler, random_rows, same


def plain_distance(left, right):
    row = list(range(len(right) + 1))
    for i, x in enumerate(left, 1):
        above, row = row, [i]
        for j, y in enumerate(right, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_distances_are_those_of_the_plain_table():
    rng = random.Random(1)
    for _ in range(400):
        titles = ["".join(rng.choices("abcé", k=rng.choice([0, 1, 5, 14, 70]))) for _ in range(rng.randint(1, 5))]
        text = "".join(rng.choices("abcdé", k=rng.choice([0, 1, 6, 80])))
        assert distances(titles, text) == [plain_distance(title, text) for title in titles]


def test_walks_keep_what_is_not_near():
    rng = random.Random(2)
    for _ in range(200):
        titles = ["".join(rng.choices("ab", k=rng.choice([0, 1, 2, 6, 7]))) for _ in range(12)]
        kept, chosen = titles[:2], []
        for place, title in enumerate(titles[2:]):
            near = any(max(map(len, (a, title))) and plain_distance(a, title) / max(len(a), len(title)) < 0.5 for a in kept)
            if len(kept) < 6 and not near:
                kept = [*kept, title]
                chosen.append(place)
        assert Titles().walk(titles[:2], titles[2:], 6) == chosen


@pytest.mark.parametrize("cells, most, rows", [(10**6, 10**6, 10_000), (100, 50, 7), (17, 1, 40)])
def test_blocks_add_up_what_articles_and_queries_share(monkeypatch, cells, most, rows):
    monkeypatch.setattr(adding, "CELLS", cells)
    monkeypatch.setattr(adding, "ADDED", most)
    rng = random.Random(3)
    terms, n_articles = 30, 60
    ids, sizes = np.array([5, 8, 13, 21, 34]), np.array([3, 1, 4, 2, 7])
    times = {(t, q): rng.randint(1, 3) for t in range(terms) for q in range(4) if rng.random() < 0.3}  # the last query has no terms
    index = adding.QueryIndex.of(*map(np.array, zip(*[(t, q, n) for (t, q), n in times.items()])), terms, ids, sizes)
    scores = [-math.inf, math.nan, 0.25, -0.5, 1.0, 3.0]
    postings = [(a * 7, t, rng.choices(scores, [1, 1, 30, 30, 30, 30])[0]) for a in range(n_articles) for t in range(terms) if rng.random() < 0.3]

    def batches():
        for i in range(0, len(postings), rows):
            slots, numbers, values = zip(*postings[i:i + rows])
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(numbers, pa.int32()), pa.array(values)], ["slot", "number", "term_score"])

    def found(run):
        return {(q, s): v for batch in run(batches()) for q, s, v in zip(*(c.to_pylist() for c in batch.columns))}

    wanted = {(int(q), s): 0.0 for q in ids for s, _, _ in postings}
    for slot, t, value in postings:
        for q in range(4):
            wanted[int(ids[q]), slot] += value * times[t, q] / 1 if (t, q) in times else 0.0
    wanted = {(q, s): v / sizes[list(ids).index(q)] for (q, s), v in wanted.items()}
    tests = {"over": lambda v: v > 0, "zero": lambda v: v == 0, "under": lambda v: v < 0 or math.isnan(v)}
    for name, test in tests.items():
        expected = {key: v for key, v in wanted.items() if test(v)}
        assert found(adding.hits_where(index, name)) == pytest.approx(expected, abs=0, nan_ok=True)
        some = index.only(np.isin(ids, [8, 34]))
        assert found(adding.hits_where(some, name)) == pytest.approx({k: v for k, v in expected.items() if k[0] in (8, 34)}, abs=0, nan_ok=True)
    best = {q: sorted((v for (p, _), v in wanted.items() if p == q and v > 0), reverse=True)[:6] for q in ids}
    lists = {q: b for batch in adding.best_of_tasks(index, 6)(batches()) for q, b in zip(*(c.to_pylist() for c in batch.columns))}
    assert {q: sorted(b, reverse=True) for q, b in lists.items()} == best
    floors = np.array([best[q][-1] if best[q] else 0.0 for q in ids])
    hits = found(adding.hits_from(index, floors, 10**6))
    assert hits == {(q, s): v for (q, s), v in wanted.items() if v > 0 and v >= floors[list(ids).index(q)]}
    few = found(adding.hits_from(index, floors, 1))
    assert {k for k, v in hits.items() if v > floors[list(ids).index(k[0])]} <= few.keys() <= hits.keys()


@pytest.fixture
def by_blocks(monkeypatch):
    """All rankings of tokens go by blocks; the list has an element for each that did."""
    monkeypatch.setattr(blocks, "LEAST_TERMS", 0)
    monkeypatch.setattr(blocks, "LEAST_ROWS", 0)
    monkeypatch.setattr(blocks, "SAMPLE", 2)
    monkeypatch.setattr(blocks, "_FIRST_ZEROS", 4)
    monkeypatch.setattr(blocks, "_MOST_ZEROS", 100)
    monkeypatch.setattr(bags, "article_bags", None)  # what blocks are there to spare
    calls, choose = [], blocks.choose
    monkeypatch.setattr(blocks, "choose", lambda *args: (calls.append(1), choose(*args))[1])
    return calls


def expected(rows, texts, **options):
    return model.rank(dict(enumerate(texts, 1)), rows, **{"stem": False, **options})


@pytest.mark.parametrize("seed, options", [
    (31, {}), (32, {"ratio": "real", "k": 3}), (33, {"dedup": False}), (34, {"prefix": 10}), (35, {"k": 30, "prefix": 2}),
])
def test_blocks_rank_as_the_plain_model_does(spark, by_blocks, seed, options):
    rows = random_rows(seed, 60)
    texts = ["red", "blue green red", "running running beta", "élan", "gamma 7", "the", "absent"]
    known = {name: value for name, value in options.items() if name != "prefix"}
    found = ranked(rank_documents(queries(spark, *texts), articles(spark, rows), Options(**{"stem": False, **options})))
    same(found, expected(rows, texts, **known))
    assert by_blocks == [1]


def test_blocks_go_beyond_the_best_hits(spark, by_blocks):
    rows = [article(f"a{i:03d}", f"the very same headline {i}", "red") for i in range(150)]
    rows += [article(f"b{i:02d}", chr(98 + i) * 9, "red long tail of words") for i in range(12)]
    rows += filler(400) + [article("z", "qqq", "blue")]
    texts = ["red", "nowhere", "blue", "of the"]
    found = ranked(rank_documents(queries(spark, *texts), articles(spark, rows), Options(stem=False)))
    same(found, expected(rows, texts))
    assert len(found[1]) == len(found[2]) == 10 and by_blocks == [1]


def test_many_queries_make_no_rows_of_article_query_and_term(spark, by_blocks):
    texts = [f"red blue{i % 7} green" for i in range(200)]
    rows = [article(f"a{i:03d}", "t" * (i % 7 + 1), "red " * (i % 3 + 1) + f"blue{i % 7} green") for i in range(300)]
    rows += filler(300)
    with Scratch(spark) as scratch:
        corpus = retrieval.Corpus(queries(spark, *texts), articles(spark, rows), Options(stem=False, ratio="real"), scratch)
        scored = corpus.scored_by_blocks()
        postings = scored._postings(None)
        assert postings.count() == 900  # a row per article and term, whatever the queries; 60,000 times two or three with these
        best = scored.best(10)
        assert best.columns == ["query_id", "slot", "score", "position"] and best.count() == 2000  # ten each
        plan = scored.titled(best)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
