"""Analysis, bags and statistics on a few articles."""

import pytest
from pyspark.sql import functions as F

from builders import article, articles, block, queries
from quillrank.operators import analysis, bags
from quillrank.operators.numbering import numbered


def texts(spark, rows):
    return {row["id"]: row["text"] for row in analysis.article_text(articles(spark, rows)).collect()}


def stats(spark, rows):
    return bags.corpus_stats(bags.article_lengths(bags.token_store(articles(spark, rows)))).first().asDict()


def test_only_the_first_five_usable_paragraphs_count(spark):
    contents = [
        block("one"), block("skipped", "caption"), None, block(None), block("two"), block(""),
        block("three"), block("four"), block("sixth"),
    ]
    found = texts(spark, [article("a", "title", contents=contents)])
    assert found == {"a": "title\none\ntwo\n\nthree\nfour"}


def test_null_contents_leave_the_title(spark):
    row = {**article("a", "title"), "contents": None}
    assert texts(spark, [row]) == {"a": "title"}


def test_articles_without_id_or_title_do_not_count(spark):
    rows = [article("a", "x y"), article(None, "x y"), article("b", None, "x y")]
    assert stats(spark, rows) == {"n_docs": 1, "total_len": 2, "avg_len": 2.0}


def test_mean_length_is_cut(spark):
    rows = [article("a", "x y z"), article("b", "w x y z")]
    assert stats(spark, rows) == {"n_docs": 2, "total_len": 7, "avg_len": 3.0}


def test_no_articles(spark):
    assert stats(spark, []) == {"n_docs": 0, "total_len": 0, "avg_len": None}


def bags_of(spark, rows, token_terms=None):
    store = bags.token_store(articles(spark, rows))
    if token_terms is not None:
        token_terms = spark.createDataFrame(token_terms, "token string, term string")
    return bags.article_bags(store, bags.matches(store, token_terms))


def test_articles_without_a_query_term_count_but_cannot_be_found(spark):
    rows = [article("a", "red blue red"), article("b", "green"), article("c", "black"), article("d", "black green pink")]
    found = bags_of(spark, rows, [("red", "red")])
    assert stats(spark, rows) == {"n_docs": 4, "total_len": 8, "avg_len": 2.0}
    assert [(r["id"], r["length"], r["copies"]) for r in found.collect()] == [("a", 3, 1)]
    assert [tuple(r) for r in bags.postings(found, ["id"]).collect()] == [("a", 1, "red", 2)]


def test_equal_articles_become_one_row(spark):
    rows = [article("a", "red", "blue")] * 3 + [article("a", "red", "green")]
    found = bags_of(spark, rows)
    assert sorted(r["copies"] for r in found.collect()) == [1, 3]
    cf = {r["term"]: r["cf"] for r in bags.term_frequencies(bags.postings(found)).collect()}
    assert cf == {"red": 4, "blue": 3, "green": 1}


def test_articles_that_differ_in_anything_stay_apart(spark):
    rows = [article("a", "b c", "d"), article("a b", "c", "d"), article("a", "b", "c d"), article("a", "b c", "d", "e")]
    assert [r["copies"] for r in bags_of(spark, rows).collect()] == [1, 1, 1, 1]


def test_stemmed_bags_add_up_the_tokens_of_a_term(spark):
    rows = [article("a", "running runs run runner")] * 2 + [article("b", "rung")]
    stems = analysis.stem_map(bags.corpus_tokens(bags.token_store(articles(spark, rows)))).where("term = 'run'")
    found = bags_of(spark, rows, [tuple(r) for r in stems.select("token", "term").collect()]).collect()
    assert [(r["id"], [tuple(e) for e in r["bag"]], r["length"], r["copies"]) for r in found if r["id"]] == [
        ("a", [("run", 3)], 4, 2)]


def test_articles_with_copies_travel_only(spark):
    rows = [article("a", "red", "blue")] * 3 + [article("a", "red", "green"), article("b", "")]
    found = bags.once_each(bags.token_store(articles(spark, rows)))
    assert sorted((r["id"], r["length"]) for r in found.collect()) == [("a", 2), ("a", 2), ("b", 0)]
    alone = bags.once_each(bags.token_store(articles(spark, rows[3:])))
    assert "Exchange hashpartitioning" not in alone._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("is_small", [True, False])
def test_postings_of_a_store(spark, is_small):
    store = bags.token_store(articles(spark, [article("a", "red blue red"), article("b", "green"), article("c", "")]))
    terms = spark.createDataFrame([("red",), ("green",), ("pink",)], "term string")
    found = bags.store_postings(store, F.broadcast(terms) if is_small else terms, is_small, ["id", "length"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert "Exchange hashpartitioning" not in plan or not is_small
    assert sorted(tuple(r) for r in found.collect()) == [("a", 3, "red", 2), ("b", 1, "green", 1)]


def test_query_terms(spark):
    df = queries(spark, "Running the race, running", "of the")
    plain = {r["query_id"]: r for r in analysis.analysed_queries(df, stem=False).collect()}
    assert plain[1]["terms"] == ["running", "race", "running"] and plain[1]["counts"] == [1, 1, 1]
    assert plain[2]["terms"] == [] and plain[2]["counts"] == []
    rows = analysis.query_term_rows(df, stem=True)
    assert sorted((r["pos"], r["n_terms"], r["term"]) for r in rows.collect()) == [
        (0, 3, "run"), (1, 3, "race"), (2, 3, "run")]
    assert {r["term"]: r["qtf"] for r in analysis.query_term_counts(rows).collect()} == {"run": 2, "race": 1}
    assert {r["term"]: r["occurrences"] for r in analysis.query_word_counts(rows).collect()} == {"run": 2, "race": 1}
    assert {r["term"] for r in analysis.query_vocabulary(rows).collect()} == {"run", "race"}


def test_numbers_are_consecutive_in_order(spark):
    df = spark.range(997).select((F.col("id") * 7919 % 997).cast("string").alias("id"), F.lit(1).alias("hot"))
    found, total = numbered(df.repartition(5), ["hot", "id"])
    assert total == 997
    in_order = [r["id"] for r in sorted(found.collect(), key=lambda r: r["number"])]
    assert in_order == sorted(in_order)
    assert found.agg(F.min("number"), F.max("number"), F.countDistinct("number")).first() == (1, 997, 997)
