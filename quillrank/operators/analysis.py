"""From text to terms, for articles and for queries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions.porter import with_stems
from quillrank.functions.tokens import tokens_of, without_stopwords
from quillrank.schema import CONTENT_ITEM
from quillrank.storage import spread

# Fixed value: how many paragraphs of an article are indexed, after its title.
PARAGRAPHS = 5


def usable_articles(articles: DataFrame) -> DataFrame:
    """Articles with an id and a title; the others count for nothing."""
    return articles.where(F.col("id").isNotNull() & F.col("title").isNotNull())


def usable_paragraphs(contents: Column) -> Column:
    """The first five blocks that are paragraphs with content. An empty text takes up a place."""
    blocks = F.coalesce(contents, F.array().cast(f"array<{CONTENT_ITEM.simpleString()}>"))
    usable = F.filter(
        blocks,
        lambda b: b.isNotNull() & (b["subtype"] == "paragraph") & b["content"].isNotNull(),
    )
    return F.slice(usable, 1, PARAGRAPHS)


def article_text(articles: DataFrame) -> DataFrame:
    """(id, title, text): the indexed text of every usable article, its pieces on separate lines."""
    paragraphs = F.transform(usable_paragraphs(F.col("contents")), lambda block: block["content"])
    return usable_articles(articles).select(
        "id", "title", F.concat_ws("\n", F.col("title"), paragraphs).alias("text")
    )


def article_tokens(articles: DataFrame) -> DataFrame:
    """(id, title, tokens): the indexed tokens of every usable article, stopwords removed.

    Splitting texts is the work of a ranking, so few large files are dealt to all cores before.
    """
    tokens = spread(article_text(articles)).select("id", "title", tokens_of(F.col("text")).alias("tokens"))
    return tokens.select("id", "title", without_stopwords("tokens").alias("tokens"))


def stem_map(tokens: DataFrame) -> DataFrame:
    """(token, term): each distinct token of column ``token`` with its stem."""
    return with_stems(tokens.select("token").distinct())


def query_term_rows(queries: DataFrame, stem: bool) -> DataFrame:
    """(query_id, pos, n_terms, term): one row per term occurrence, in query order, repeats kept.

    A query of stopwords only has no rows.
    """
    kept = queries.select("query_id", tokens_of(F.col("query")).alias("tokens")).select(
        "query_id", without_stopwords("tokens").alias("tokens")
    )
    rows = kept.select(
        "query_id",
        F.size("tokens").cast("bigint").alias("n_terms"),
        F.posexplode("tokens").alias("pos", "token"),
    )
    if stem:
        rows = rows.join(stem_map(rows), "token")
    else:
        rows = rows.withColumn("term", F.col("token"))
    return rows.select("query_id", "pos", "n_terms", "term")


def analysed_queries(queries: DataFrame, stem: bool) -> DataFrame:
    """(query_id, query, terms, counts): every query with its terms, and a count of 1 for each."""
    terms = (
        query_term_rows(queries, stem)
        .groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("placed"))
    )
    found = F.coalesce(F.transform("placed", lambda p: p["term"]), F.array().cast("array<string>"))
    return queries.join(terms, "query_id", "left").select(
        "query_id", "query", found.alias("terms"), F.array_repeat(F.lit(1), F.size(found)).alias("counts")
    )


def query_word_counts(term_rows: DataFrame) -> DataFrame:
    """(term, occurrences) over all queries."""
    return term_rows.groupBy("term").agg(F.count("*").alias("occurrences"))


def query_vocabulary(term_rows: DataFrame) -> DataFrame:
    """The distinct terms of all queries."""
    return term_rows.select("term").distinct()


def query_term_counts(term_rows: DataFrame) -> DataFrame:
    """(query_id, term, n_terms, qtf): how often each query has each of its terms."""
    return term_rows.groupBy("query_id", "term", "n_terms").agg(F.count("*").alias("qtf"))
