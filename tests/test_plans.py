"""The shape of physical plans: what is pushed down, what is shuffled, what runs in Python."""

import re

import pytest
from pyspark.sql import functions as F

from builders import article, articles, queries
from quillrank import Options, storage
from quillrank.functions import titles
from quillrank.functions.titles import is_near_duplicate
from quillrank.operators import analysis, bags, pruning, scoring, selection
from quillrank.plans.registry import QUERIES
from quillrank.plans.retrieval import Corpus
from quillrank.sources import files, tables
from quillrank.storage import Scratch


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def corpora(spark):
    rows = articles(spark, [article(str(i), f"title {i}", "red blue running") for i in range(20)])
    with Scratch(spark) as scratch:
        yield [Corpus(queries(spark, "red", "blue red"), rows, Options(stem=stem), scratch) for stem in (False, True)]


def test_scoring_neither_shuffles_nor_leaves_the_jvm(corpora):
    for corpus in corpora:
        plan = plan_of(corpus.hits())
        assert "Python" not in plan and "ArrowEval" not in plan
        assert "Exchange hashpartitioning" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("prefix", [100, selection.LONGEST_PREFIX])
def test_best_hits_are_cut_before_the_shuffle(corpora, prefix):
    for corpus in corpora:
        plan = plan_of(selection.best_hits(corpus.hits(), prefix))
        # Two cuts, each before and after its shuffle.
        assert plan.count("WindowGroupLimit") == 4
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_title_has_one_profile(corpora):
    held = selection.best_hits(corpora[0].hits(), 100)
    choice = selection.new_choice(corpora[0].term_rows)
    assert plan_of(held).count("replace(title") == plan_of(held).count("length(replace(title") == len(titles._COUNTED)
    stored = corpora[0]._scratch.stored(held)
    assert "replace(" not in plan_of(selection._walked(choice, stored, 10, True))


def test_later_rounds_drop_near_duplicates_before_the_shuffle(corpora):
    corpus = corpora[0]
    choice = selection.next_stretch(selection.new_choice(corpus.term_rows), 10)
    hits = selection._placed(corpus.hits(choice.select("query_id"))).withColumn("profile", titles.title_profile(F.col("title")))
    plan = plan_of(selection._first_hits(selection._still_wanted(choice, hits, True), 100))
    assert "levenshtein" in plan[plan.index("Partial"):]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pruned_scoring_shuffles_no_articles(corpora):
    for corpus in corpora:
        plan = plan_of(pruning.pruned_hits(corpus.bags, corpus.weights, 100, corpus._scratch))
        assert "Exchange hashpartitioning" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_nothing_leaves_the_jvm(spark, corpora):
    store = corpora[0].store
    for df in (
        analysis.stem_map(bags.corpus_tokens(store)), bags.token_store(articles(spark, [article("a", "title")])),
        bags.article_bags(store, bags.matches(store, corpora[1].term_rows.selectExpr("term as token", "term"))),
    ):
        assert "Python" not in plan_of(df) and "ArrowEval" not in plan_of(df)


def read_schemas(df):
    return sorted(set(re.findall(r"ReadSchema: struct<(.*)>", plan_of(df))))


def test_the_store_is_read_by_column(corpora):
    store = corpora[0].store
    entry = "array<struct<token:string"
    assert read_schemas(bags.article_lengths(store)) == ["length:int"]
    assert read_schemas(bags.corpus_tokens(store)) == [f"entries:{entry}>>"]
    found = bags.matches(store, None)
    assert read_schemas(found) == [f"fingerprint:binary,entries:{entry},tf:int>>"]
    assert "fingerprint:binary,id:string,title:string,length:int" in read_schemas(bags.article_bags(store, found))


@pytest.fixture
def stored_documents(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(
        [(1, "a\nb", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(path)
    return tables.documents_as_articles(spark.read.parquet(path))


def test_the_store_takes_one_scan_and_one_tokenisation(stored_documents):
    plan = plan_of(bags.token_store(stored_documents))
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 1
    assert "PushedFilters: [IsNotNull(doc_id), IsNotNull(text)]" in plan
    assert plan.count("regexp_extract_all") == 1


def test_large_inputs_are_not_dealt_out(stored_documents, monkeypatch):
    assert "REPARTITION_BY_NUM" in plan_of(bags.token_store(stored_documents))
    monkeypatch.setattr(storage, "_SPREAD_BYTES", 1)
    assert "Exchange" not in plan_of(bags.token_store(stored_documents))


def test_the_vocabulary_is_met_before_the_shuffle(spark, corpora):
    words = spark.createDataFrame([("red", "red")], "token string, term string")
    plan = plan_of(bags.matches(corpora[0].store, F.broadcast(words)))
    assert "BroadcastHashJoin" in plan[plan.rindex("Exchange hashpartitioning"):]
    assert "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_large_vocabulary_takes_a_join_that_can_be_split(spark, corpora):
    words = spark.createDataFrame([("red", "red")], "token string, term string").hint("merge")
    plan = plan_of(bags.matches(corpora[0].store, words))
    assert "SortMergeJoin" in plan and plan.startswith("AdaptiveSparkPlan")


def test_json_articles_decode_only_what_is_indexed(spark, tmp_path):
    path = tmp_path / "a.jl"
    path.write_text('{"id": "a", "title": "t", "contents": []}')
    plan = plan_of(bags.token_store(files.read_articles(spark, str(path))))
    scan = plan[plan.index("ReadSchema"):]
    assert "author" not in scan and "published_date" not in scan and "bio" not in scan


def test_near_duplicates_need_no_cross_product(spark):
    df = spark.createDataFrame([("a", "b")], "a string, b string")
    assert "Python" not in plan_of(df.where(is_near_duplicate(F.col("a"), F.col("b"))))


@pytest.mark.parametrize("groups", [1, 3])
def test_all_hits_are_dealt_once_and_summed_without_shuffle(spark, corpora, monkeypatch, groups):
    corpus = corpora[0]
    monkeypatch.setattr(scoring, "WEIGHTS_A_TASK", 4 - groups)
    hits = scoring.all_hits(bags.once_each(corpus.store), corpus.weights)
    plan = plan_of(hits)
    assert plan.count("REPARTITION_BY_NUM") == plan.count("Exchange hashpartitioning") == groups
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    wanted = corpus.hits().select("query_id", "id", "score")
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, wanted.collect())) and not wanted.isEmpty()


def test_all_hits_keep_the_driver_small(spark, corpora, monkeypatch):
    for name, value in (("ROWS_A_TASK", 1), ("WEIGHTS_A_TASK", 1), ("MOST_TASKS", 9)):
        monkeypatch.setattr(scoring, name, value, raising=False)
    corpus = corpora[0]
    hits = scoring.all_hits(bags.once_each(corpus.store), corpus.weights)
    plan = plan_of(hits)
    assert sum(map(int, re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", plan))) <= 9
    wanted = corpus.hits().select("query_id", "id", "score")
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, wanted.collect()))
    # Queries of a term travel in one row.
    index = scoring._term_index(corpus.weights, 1)
    assert sorted((r["term"], sorted(r["query_id"])) for r in index.collect()) == [("blue", [2]), ("red", [1, 2])]


def test_tasks_of_all_hits_follow_the_sums():
    million = 1_000_000
    assert scoring.tasks_of_all_hits(12, 1, 10, 10, 50) == 12
    assert scoring.tasks_of_all_hits(12, 1, million, 20, 100 * million) == 12  # 20 million sums, not 100
    assert scoring.tasks_of_all_hits(12, 2, million, 200, 1000 * million) == 50  # 200 million sums in two groups
    assert scoring.tasks_of_all_hits(100, 7, million, million, million**2) * 7 <= scoring.MOST_TASKS


def test_named_results_are_not_written(spark):
    for name in ("postings", "term_corpus_frequency", "user_query_scores"):
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "explode" in plan  # a checkpoint would be an existing RDD
