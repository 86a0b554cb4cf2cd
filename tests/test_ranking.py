"""Whole rankings, each rule on a corpus made for it, and random corpora against the plain model."""

import math
import random
import re

import pytest

import model
from builders import article, articles, queries, ranked
from quillrank import Options, rank_documents, read_index, write_index
from quillrank.operators import bags, padding, pruning, scoring, selection
from quillrank.plans import retrieval
from quillrank.storage import Scratch

PLAIN = Options(stem=False)


def run(spark, rows, texts, options=PLAIN):
    return ranked(rank_documents(queries(spark, *texts), articles(spark, rows), options))


def expected(rows, texts, **options):
    return model.rank(dict(enumerate(texts, 1)), rows, **{"stem": False, **options})


def same(found, wanted):
    assert {q: [id for id, _ in hits] for q, hits in found.items()} == {
        q: [id for id, _ in hits] for q, hits in wanted.items()}
    for q, hits in wanted.items():
        for (_, score), (_, other) in zip(found[q], hits):
            assert score == pytest.approx(other, abs=1e-9, nan_ok=True)


def filler(count, start=0):
    """Articles with titles that have nothing in common."""
    alphabet = "bcdfghjklmnpqrstvwxz"
    return [article(f"f{start + i:04d}", alphabet[i % 20] * (5 + i // 20), "padding words here") for i in range(count)]


def test_frequent_terms_score_minus_infinity_and_rank_after_the_padding(spark):
    rows = [article("a", "alpha", "red red red"), article("b", "zzzzzzzz", "blue red red"), article("c", "wow", "blue")]
    found = run(spark, rows, ["red", "blue"])
    same(found, expected(rows, ["red", "blue"]))
    assert [id for id, _ in found[1]] == ["c", "a", "b"]
    assert found[1][1][1] == -math.inf
    real = run(spark, rows, ["red", "blue"], Options(stem=False, ratio="real"))
    same(real, expected(rows, ["red", "blue"], ratio="real"))
    assert not any(math.isinf(score) for _, score in real[1])


def test_an_article_of_one_repeated_term_ranks_last(spark):
    rows = [article("a", "red", "red red"), article("b", "omega red"), article("c", "zzz blue yellow"), *filler(5)]
    found = run(spark, rows, ["red", "blue"])
    same(found, expected(rows, ["red", "blue"]))
    assert found[1][-1][0] == "a" and math.isnan(found[1][-1][1])


def test_repeated_query_terms_count_again(spark):
    rows = [article("a", "alpha red blue x y"), article("b", "omega blue x y z w"), *filler(20)]
    texts = ["red red blue", "red blue"]
    found = run(spark, rows, texts)
    same(found, expected(rows, texts))
    assert found[1][0][1] != found[2][0][1]


def test_queries_without_terms_or_matches(spark):
    rows = [article("a", "alpha red"), article("b", "omega blue"), *filler(3)]
    texts = ["of the", "nowhere", "red blue"]
    found = run(spark, rows, texts)
    assert 1 not in found
    assert found[2] == [("a", 0.0), ("b", 0.0)]
    assert 2 not in run(spark, rows, texts, Options(stem=False, pad_zero=False))


def test_titles_at_the_threshold_are_kept(spark):
    rows = [article("a", "ab", "red"), article("b", "ac", "red"), article("c", "xyz", "red"), article("d", "xyw", "red")]
    found = run(spark, rows + filler(10), ["red"])
    assert [id for id, _ in found[1]] == ["a", "b", "c"]


def test_empty_titles_are_no_duplicates_and_copies_of_them_stay(spark):
    rows = [article("a", "", "red x")] * 3 + [article("b", "", "red x"), article("c", "title", "red x")] * 2
    found = run(spark, rows + filler(10), ["red"])
    same(found, expected(rows + filler(10), ["red"]))
    assert [id for id, _ in found[1]] == ["c", "a", "a", "a", "b", "b"]


def test_equal_ids_are_separate_candidates(spark):
    rows = [article("a", "alpha", "red x"), article("a", "omega", "red x y"), *filler(10)]
    found = run(spark, rows, ["red"])
    same(found, expected(rows, ["red"]))
    assert [id for id, _ in found[1]] == ["a", "a"]


def test_a_long_run_of_near_duplicates_takes_more_rounds(spark):
    rows = [article(f"a{i:03d}", f"the very same headline {i}", "red") for i in range(150)]
    rows += [article(f"b{i:02d}", chr(98 + i) * 9, "red long tail of words") for i in range(12)]
    texts = ["red", "nowhere", "blue"]
    rows += filler(400) + [article("z", "qqq", "blue")]
    found = run(spark, rows, texts)
    same(found, expected(rows, texts))
    assert len(found[1]) == 10
    plain = run(spark, rows, texts, Options(stem=False, dedup=False))
    same(plain, expected(rows, texts, dedup=False))


def test_padding_goes_through_blocks_of_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(padding, "_RUN", 64)
    # Six hundred candidates with one title and the lowest ids, then distinct ones.
    rows = [article(f"a{i:04d}", "the very same headline", f"red number{i}") for i in range(600)]
    rows += [article(f"b{i:02d}", chr(98 + i) * 9, "red") for i in range(12)]
    rows += filler(900)
    found = run(spark, rows, ["red", "nowhere"], Options(stem=False, prefix=10))
    same(found, expected(rows, ["red", "nowhere"]))
    assert len(found[2]) == 10


def test_no_articles(spark):
    assert run(spark, [], ["red"]) == {}


class Counting:
    """Stands in for a function and counts its calls, and the rows of what it returns if asked to."""

    def __init__(self, function, rows=False):
        self.calls, self.rows, self._function, self._count = 0, [], function, rows

    def __call__(self, *args, **kwargs):
        self.calls += 1
        found = self._function(*args, **kwargs)
        if self._count:
            self.rows.append(found.count())
        return found


def test_articles_are_analysed_and_scored_once(spark, monkeypatch):
    analysed = Counting(bags.token_store)
    scored = Counting(scoring.scored_hits)
    monkeypatch.setattr(bags, "token_store", analysed)
    monkeypatch.setattr(scoring, "scored_hits", scored)
    rows = [article(f"a{i:03d}", f"the very same headline {i}", "red") for i in range(150)] + filler(400)
    rows += [article("z", "qqq", "blue"), article("y", "zzz", "blue"), *[article(f"b{i}", chr(98 + i) * 9, "red tail") for i in range(12)]]
    texts = ["red", "blue", "nowhere", "padding"]
    for options in (PLAIN, Options(stem=True), Options(stem=False, pad_zero=False)):
        found = run(spark, rows, texts, options)
        same(found, expected(rows, texts, stem=options.stem, pad_zero=options.pad_zero))
        assert (analysed.calls, scored.calls) == (1, 1)
        analysed.calls = scored.calls = 0


def test_articles_are_scored_again_for_queries_that_use_up_their_hits(spark, monkeypatch):
    scored = Counting(scoring.scored_hits)
    monkeypatch.setattr(scoring, "scored_hits", scored)
    rows = [article(f"a{i:03d}", f"the very same headline {i}", "red red one more word") for i in range(150)]
    rows += [article(f"b{i}", chr(98 + i) * 9, "red tail of words that go on") for i in range(12)] + filler(700)
    found = run(spark, rows, ["red", "padding"], Options(stem=False, prefix=10))
    same(found, expected(rows, ["red", "padding"]))
    assert scored.calls > 1


def test_short_queries_are_offered_what_they_need(spark, monkeypatch):
    offers = Counting(padding.offers, rows=True)
    monkeypatch.setattr(padding, "offers", offers)
    rows = [article(f"m{i}", chr(98 + i) * 9, "red") for i in range(5)] + [article("n", "zzzz", "blue")] + filler(900)
    texts = ["red", "blue", "nowhere", "padding"]
    found = run(spark, rows, texts)
    same(found, expected(rows, texts))
    # A prefix of 100 for each of three queries, besides as many as they match.
    assert offers.rows == [3 * 100 + 5 + 1 + 0]


def test_an_index_serves_many_rankings(spark, tmp_path, monkeypatch):
    rows = [article("a", "alpha red"), article("b", "omega blue"), article("b", "omega blue"), *filler(12)]
    path = str(tmp_path / "index")
    write_index(articles(spark, rows[:2]), path)
    write_index(articles(spark, rows[2:]), path, mode="append")
    monkeypatch.setattr(bags, "token_store", None)
    index = read_index(spark, path)
    for texts in (["red", "blue"], ["padding reds"]):
        for options in (PLAIN, Options()):
            found = ranked(rank_documents(queries(spark, *texts), index, options))
            same(found, expected(rows, texts, stem=options.stem))


def test_settings_of_the_session_stay(spark, monkeypatch):
    rows = [article("a", "alpha red"), *filler(3)]

    def refuse(*_):
        raise AssertionError("a ranking must not change settings that other threads use")

    monkeypatch.setattr(type(spark.conf), "set", refuse)
    assert run(spark, rows, ["red"])[1][0][0] == "a"


@pytest.mark.parametrize("seed, options", [(21, {}), (22, {"stem": True, "ratio": "real"}), (23, {"pad_zero": False}), (24, {"dedup": False, "k": 3})])
def test_pruned_scoring_finds_the_same_hits(spark, monkeypatch, seed, options):
    monkeypatch.setattr(pruning, "LEAST_ROWS", 0)
    monkeypatch.setattr(pruning, "SAMPLE", 2)
    pruned = Counting(pruning.pruned_hits)
    monkeypatch.setattr(pruning, "pruned_hits", pruned)
    rows = random_rows(seed, 150)
    texts = ["red", "blue green red running", "running running beta the alpha 7", "élan", "absent"]
    found = run(spark, rows, texts, Options(**{"stem": False, "prefix": 10, **options}))
    same(found, expected(rows, texts, **options))
    assert pruned.calls == 1


def test_pruning_scores_fewer_articles(spark, monkeypatch):
    monkeypatch.setattr(pruning, "LEAST_ROWS", 0)
    rng = random.Random(6)
    rows = []
    for i in range(600):
        words = ["common"] * rng.randint(1, 2) + ["often"] * rng.randint(0, 2) + (["rare"] * 3 if i % 5 == 0 else [])
        rows.append(article(f"a{i:04d}", "".join(rng.choices("bcdfgh", k=12)), " ".join(words + rng.choices(["pad", "fill", "stuff"], k=9))))
    texts = ["rare common often"]
    with Scratch(spark) as scratch:
        corpus = retrieval.Corpus(queries(spark, *texts), articles(spark, rows), Options(stem=False, ratio="real"), scratch)
        whole = {r["id"]: r["score"] for r in corpus.hits().collect()}
        hits = pruning.pruned_hits(corpus.bags, corpus.weights, 5, scratch).collect()
    floor = hits[0]["floor"]
    assert len(hits) * 2 < len(whole) == 600
    assert {r["id"]: r["score"] for r in hits if r["score"] >= floor} == {i: s for i, s in whole.items() if s >= floor}
    assert sum(s >= floor for s in whole.values()) >= 5


@pytest.mark.parametrize("pays", [True, False])
def test_long_queries_are_scored_by_all_terms_at_once(spark, monkeypatch, pays):
    completed = Counting(pruning._completed_hits)
    monkeypatch.setattr(pruning, "_completed_hits", completed)
    monkeypatch.setattr(pruning, "SAMPLE", 2)
    rows = [article(f"a{i:03d}", "t" * (i % 7 + 1), "red " * (i % 3 + 1) + "blue " * (i % 5) + "green") for i in range(80)] + filler(200)
    if pays:
        monkeypatch.setattr(pruning, "_pays", lambda *_: True)
    with Scratch(spark) as scratch:
        corpus = retrieval.Corpus(queries(spark, "red blue green", "padding"), articles(spark, rows), PLAIN, scratch)
        columns = ["query_id", "id", "title", "length", "fingerprint", "copies", "score"]
        whole = {tuple(r[c] for c in columns) for r in corpus.hits().collect()}
        plan_input = pruning.pruned_hits(corpus.bags, corpus.weights, 5, scratch)
        hits = plan_input.collect()
        aggregates = re.findall(r"HashAggregate\(keys=\[(.*?)\]", plan_input._jdf.queryExecution().executedPlan().toString())
    assert completed.calls == pays and aggregates
    assert not any("title" in keys for keys in aggregates)  # nothing is summed by title
    floors = {r["query_id"]: r["floor"] for r in hits}
    found = {tuple(r[c] for c in columns) for r in hits}
    assert found == {r for r in whole if floors[r[0]] is None or r[-1] >= floors[r[0]]}


WORDS = "red reds blue bluest green greens running runs alpha beta gamma the of 7 élan".split()


def random_rows(seed, count):
    rng = random.Random(seed)

    def text(least, most):
        return " ".join(rng.choices(WORDS, weights=range(len(WORDS), 0, -1), k=rng.randint(least, most)))

    rows = []
    for i in range(count):
        title = rng.choice(["", text(1, 2), text(1, 5), text(3, 6), None])
        row = article(str(rng.randint(0, count)), title, *[text(0, 6) for _ in range(rng.randint(0, 7))])
        rows += [row] * rng.choice([1, 1, 1, 2, 12])
    return rows


@pytest.mark.parametrize("seed, options", [
    (1, {}),
    (2, {"stem": True}),
    (3, {"pad_zero": False}),
    (4, {"ratio": "real", "k": 3}),
    (5, {"dedup": False}),
    (6, {"stem": True, "ratio": "real"}),
    (7, {"prefix": 10}),
    (9, {"k": 30, "longest": 7}),
    (10, {"k": 30, "longest": 7, "dedup": False}),
    (8, {"stem": True, "pad_zero": False, "ratio": "real", "prefix": 10}),
])
def test_random_corpora_rank_as_the_plain_model_does(spark, monkeypatch, seed, options):
    options = dict(options)
    monkeypatch.setattr(selection, "LONGEST_PREFIX", options.pop("longest", selection.LONGEST_PREFIX))
    rows = random_rows(seed, 60)
    texts = ["red", "blue green red", "running running beta", "élan", "gamma 7", "the", "absent"]
    known = {name: value for name, value in options.items() if name != "prefix"}
    found = run(spark, rows, texts, Options(**{"stem": False, **options}))
    same(found, expected(rows, texts, **known))
