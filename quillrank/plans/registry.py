"""Named queries over the given tables, one per operator of the engine and one per kind of ranking."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank import sinks
from quillrank.functions.titles import title_distance
from quillrank.operators import analysis, assembly, bags, scoring
from quillrank.plans.retrieval import Corpus, Options, rank_documents, small_terms
from quillrank.schema import QUERY
from quillrank.sources import files, tables
from quillrank.storage import Scratch, broadcast_if_small, checkpointed, kept

# Queries put to the documents table.
DOCUMENT_QUERIES = [
    (1, "thtion attion"),
    (2, "ertion thanea eriner"),
    (3, "ntble ntble inti"),
    (4, "thanonnt"),
    (5, "zzzzqq"),
    (6, "the of and"),
    (7, "thtion la"),
]

EXACT = Options(stem=False)


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    return tables.documents_as_articles(tables.read_table(spark, sf, "documents"))


def _page_articles(spark: SparkSession, sf: str) -> DataFrame:
    return tables.pages_as_articles(tables.read_table(spark, sf, "pages"))


def _document_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DOCUMENT_QUERIES, QUERY)


def _user_queries(spark: SparkSession, sf: str) -> DataFrame:
    return tables.user_turns_as_queries(tables.read_table(spark, sf, "conversations"))


def _benchmark_queries(spark: SparkSession, sf: str) -> DataFrame:
    return tables.benchmark_as_queries(tables.read_table(spark, sf, "benchmark"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


def query_terms(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.analysed_queries(_user_queries(spark, sf), stem=False).select(
        "query_id",
        "query",
        F.array_join("terms", " ").alias("terms"),
        F.array_join(F.transform("counts", lambda n: n.cast("string")), " ").alias("counts"),
    )


def query_term_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = analysis.query_term_rows(_benchmark_queries(spark, sf), stem=False)
    return rows.select("query_id", "n_terms", "term").groupBy("query_id", "n_terms", "term").agg(
        F.count("*").alias("qtf")
    )


def query_word_count(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.query_word_counts(analysis.query_term_rows(_user_queries(spark, sf), stem=False))


def query_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.query_vocabulary(analysis.query_term_rows(_user_queries(spark, sf), stem=False))


def article_text(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.article_text(_articles(spark, sf))


def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.article_text(_page_articles(spark, sf))


def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return bags.corpus_stats(bags.article_lengths(bags.token_store(_articles(spark, sf))))


def _user_terms(spark: SparkSession, sf: str) -> tuple[DataFrame, bool]:
    """The vocabulary of the user turns, stored, and whether it is hinted to be broadcast."""
    terms = checkpointed(analysis.query_vocabulary(analysis.query_term_rows(_user_queries(spark, sf), stem=False)))
    hinted = small_terms(terms, "term")
    return hinted, hinted is not terms


def _document_corpus(spark: SparkSession, sf: str, scratch: Scratch) -> Corpus:
    return Corpus(_document_queries(spark), _articles(spark, sf), EXACT, scratch)


def postings(spark: SparkSession, sf: str) -> DataFrame:
    terms, is_small = _user_terms(spark, sf)
    articles = bags.once_each(bags.token_store(_articles(spark, sf)))
    return bags.store_postings(articles, terms, is_small, ["id", "length"])


def term_corpus_frequency(spark: SparkSession, sf: str) -> DataFrame:
    terms, is_small = _user_terms(spark, sf)
    found = bags.store_postings(bags.token_store(_articles(spark, sf)), terms, is_small, [])
    return found.groupBy("term").agg(F.sum("tf").alias("cf"))


def dph_term_scores(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        corpus = _document_corpus(spark, sf, scratch)
        weights = corpus.weights.select("term", "cf", "rarity", "avg_len").distinct()
        scored = scoring.term_scores(corpus.postings(), weights)
        return checkpointed(_rounded(scored.select("id", "term", "tf", "length", "cf", "term_score"), "term_score"))


def query_scores(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        hits = _document_corpus(spark, sf, scratch).hits()
        return checkpointed(_rounded(hits.select("query_id", "id", "score"), "score"))


def user_query_scores(spark: SparkSession, sf: str) -> DataFrame:
    """All hits: as many as there are queries times articles, but for a factor; only the articles and the weights are written."""
    with Scratch(spark) as scratch:
        term_rows = scratch.stored(analysis.query_term_rows(_user_queries(spark, sf), stem=False))
        store = scratch.stored(bags.token_store(_articles(spark, sf)).drop("title"))
        terms = scratch.stored(analysis.query_vocabulary(term_rows))
        hinted = small_terms(terms, "term")
        frequencies = bags.store_postings(store, hinted, hinted is not terms, []).groupBy("term").agg(F.sum("tf").alias("cf"))
        stats = bags.corpus_stats(bags.article_lengths(store))
        counts = analysis.query_term_counts(term_rows)
        weights = kept(scoring.term_weights(counts, frequencies, stats, EXACT.ratio).where("cf > 0"))
        articles = kept(bags.once_each(store))
    return _rounded(scoring.all_hits(articles, weights), "score")


def title_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Every scored hit against the best hit of its query."""
    with Scratch(spark) as scratch:
        hits = _document_corpus(spark, sf, scratch).hits().select("query_id", "id", "title", "score")
        best = scratch.stored(hits.groupBy("query_id").agg(F.max(F.struct("score", "id", "title")).alias("best")))
        best = broadcast_if_small(best, F.length("best.title") * 4 + 64, 100_000, 64 << 20)
        return checkpointed(hits.join(best, "query_id").select(
            "query_id", "id", F.round(title_distance(F.col("best.title"), F.col("title")), 6).alias("distance")
        ))


def _document_hits(spark: SparkSession, sf: str, options: Options) -> DataFrame:
    return rank_documents(_document_queries(spark), _articles(spark, sf), options)


def _ranking(options: Options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: _rounded(_document_hits(spark, sf, options), "score")


def user_query_top10(spark: SparkSession, sf: str) -> DataFrame:
    hits = rank_documents(_user_queries(spark, sf), _articles(spark, sf), EXACT)
    return _rounded(hits, "score").drop("query")


def benchmark_page_top10(spark: SparkSession, sf: str) -> DataFrame:
    hits = rank_documents(_benchmark_queries(spark, sf), _page_articles(spark, sf), EXACT)
    return _rounded(hits, "score").drop("query")


def hits_ascending(spark: SparkSession, sf: str) -> DataFrame:
    lists = assembly.ascending(_document_hits(spark, sf, EXACT))
    return lists.select("query_id", F.posexplode("results").alias("position", "hit")).select(
        "query_id", "position", "hit.id", F.round("hit.score", 6).alias("score")
    )


def result_ids(spark: SparkSession, sf: str) -> DataFrame:
    return assembly.result_ids(_document_hits(spark, sf, EXACT))


def result_articles(spark: SparkSession, sf: str) -> DataFrame:
    articles = _articles(spark, sf)
    found = assembly.result_articles(rank_documents(_document_queries(spark), articles, EXACT), articles)
    return found.select("id", "title", "source", F.size("contents").alias("n_blocks"))


def document_ranking(spark: SparkSession, sf: str) -> DataFrame:
    articles = _articles(spark, sf)
    lists = assembly.document_rankings(rank_documents(_document_queries(spark), articles, EXACT), articles)
    return lists.select("query_id", "query", F.posexplode("results").alias("position", "hit")).select(
        "query_id",
        "query",
        "position",
        "hit.docid",
        "hit.article.title",
        "hit.article.source",
        F.size("hit.article.contents").alias("n_blocks"),
        F.round("hit.score", 6).alias("score"),
    )


def rendered_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return assembly.rendered(_document_hits(spark, sf, EXACT), decimals=6)


def json_article_source(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        folder = scratch.path()
        _articles(spark, sf).write.json(folder)
        return checkpointed(files.read_articles(spark, folder).select(
            "id", "title", "source", F.array_join(F.col("contents.content"), "\n").alias("body")
        ))


def parsed_article_source(spark: SparkSession, sf: str) -> DataFrame:
    """The articles as JSON lines of text, read line by line and parsed."""
    with Scratch(spark) as scratch:
        folder = scratch.path()
        _articles(spark, sf).select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
        return checkpointed(files.parse_articles(files.read_lines(spark, folder)).select(
            "id", "title", "source", F.array_join(F.col("contents.content"), "\n").alias("body")
        ))


def text_query_source(spark: SparkSession, sf: str) -> DataFrame:
    """Queries as lines of text, read back; line numbers depend on the files, so equal queries are counted."""
    with Scratch(spark) as scratch:
        folder = scratch.path()
        _user_queries(spark, sf).select(F.regexp_replace("query", "[\r\n]+", " ").alias("value")).write.text(folder)
        analysed = analysis.analysed_queries(files.read_queries(spark, folder), stem=False)
        return checkpointed(
            analysed.groupBy("query", F.array_join("terms", " ").alias("terms")).agg(F.count("*").alias("queries"))
        )


def _mixed_articles(spark: SparkSession, sf: str) -> DataFrame:
    return tables.conversations_as_articles(tables.read_table(spark, sf, "conversations"))


def stemmed_terms(spark: SparkSession, sf: str) -> DataFrame:
    """The stem of every token of the corpus."""
    return analysis.stem_map(bags.corpus_tokens(bags.token_store(_articles(spark, sf))))


def mixed_article_text(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.article_text(_mixed_articles(spark, sf))


def mixed_corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return bags.corpus_stats(bags.article_lengths(bags.token_store(_mixed_articles(spark, sf))))


def rendered_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The rendered files read back: the first line of a file is the query, every other one a hit."""
    hit = r"^  (\d+):(\S*) (\S+) (.*)$"
    with Scratch(spark) as scratch:
        folder = scratch.path()
        sinks.write_rendered(_document_hits(spark, sf, EXACT), folder)
        written = spark.read.text(folder, wholetext=True)
        lines = written.select(
            F.col("query_id").cast("bigint").alias("query_id"), F.split("value", "\n").alias("lines")
        ).select("query_id", F.get("lines", F.lit(0)).alias("query"), F.explode(F.filter("lines", lambda x, i: (i > 0) & (x != ""))).alias("line"))
        part = lambda n: F.regexp_extract("line", hit, n)
        return checkpointed(lines.select(
            "query_id", "query", part(1).cast("int").alias("rank"), part(2).alias("id"),
            F.round(part(3).cast("double"), 6).alias("score"), part(4).alias("title"),
        ))


def ranking_sink(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        folder = scratch.path()
        sinks.write_hits(_document_hits(spark, sf, EXACT), folder)
        return checkpointed(spark.read.parquet(folder).select(
            F.col("query_id").cast("bigint").alias("query_id"), "file_name", "rank", "id", "title",
            F.round("score", 6).alias("score"),
        ))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "query_terms": query_terms,
    "query_term_rows": query_term_rows,
    "query_word_count": query_word_count,
    "query_vocabulary": query_vocabulary,
    "article_text": article_text,
    "page_text": page_text,
    "corpus_stats": corpus_stats,
    "postings": postings,
    "term_corpus_frequency": term_corpus_frequency,
    "dph_term_scores": dph_term_scores,
    "query_scores": query_scores,
    "user_query_scores": user_query_scores,
    "title_distance": title_distances,
    "ranked_top10": _ranking(Options(stem=False, dedup=False)),
    "deduplicated_top10": _ranking(EXACT),
    "real_ratio_top10": _ranking(Options(stem=False, ratio="real")),
    "unpadded_top10": _ranking(Options(stem=False, pad_zero=False)),
    "user_query_top10": user_query_top10,
    "benchmark_page_top10": benchmark_page_top10,
    "hits_ascending": hits_ascending,
    "result_ids": result_ids,
    "result_articles": result_articles,
    "document_ranking": document_ranking,
    "rendered_ranking": rendered_ranking,
    "json_article_source": json_article_source,
    "parsed_article_source": parsed_article_source,
    "text_query_source": text_query_source,
    "mixed_article_text": mixed_article_text,
    "mixed_corpus_stats": mixed_corpus_stats,
    "ranking_sink": ranking_sink,
    "rendered_sink": rendered_sink,
    "stemmed_terms": stemmed_terms,
    "stemmed_ranking": _ranking(Options()),
}
