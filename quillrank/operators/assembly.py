"""From chosen hits back to whole articles, and to text."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrank.operators.bloom import may_have_partner
from quillrank.schema import ARTICLE
from quillrank.storage import broadcast_if_small, checkpointed

_IDS = 1_000_000
_ID_BYTES = 64 << 20


def result_ids(hits: DataFrame) -> DataFrame:
    """The distinct ids of all hits."""
    return hits.select("id").distinct()


def result_articles(hits: DataFrame, articles: DataFrame) -> DataFrame:
    """The articles that are a hit of any query, all rows of each.

    Beyond the size that is broadcast the ids meet the articles by shuffle; a Bloom filter of the ids then drops nearly all other
    articles in the scan, so that little more than the result is shuffled.
    """
    ids = checkpointed(result_ids(hits))
    few = broadcast_if_small(ids, F.length("id") * 4 + 32, _IDS, _ID_BYTES)
    if few is ids:
        articles = may_have_partner(articles, ids, "id")
    return articles.join(few, "id", "left_semi")


def one_per_id(articles: DataFrame) -> DataFrame:
    """The least row of every id, by its fields in order. Copies are cut per task first."""
    fields = [field.name for field in ARTICLE if field.name != "id"]
    order = Window.partitionBy("id").orderBy(*fields)
    return articles.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")


def document_rankings(hits: DataFrame, articles: DataFrame) -> DataFrame:
    """(query_id, query, results): the hits of each query in rank order, with their articles.

    Articles are read again for the ids of hits only, so that scoring never carries them.
    """
    found = one_per_id(result_articles(hits, articles)).select(
        "id", F.struct(*ARTICLE.fieldNames()).alias("article")
    )
    placed = hits.join(found, "id", "left").select(
        "query_id", "query", F.struct("rank", F.col("id").alias("docid"), "article", "score").alias("result")
    )
    return placed.groupBy("query_id", "query").agg(F.collect_list("result").alias("results")).select(
        "query_id",
        "query",
        F.array_sort("results", lambda a, b: a["rank"] - b["rank"]).alias("results"),
    )


def ascending(hits: DataFrame) -> DataFrame:
    """(query_id, query, results): the hits of each query as (score, rank, id), lowest score first."""
    return hits.groupBy("query_id", "query").agg(
        F.array_sort(F.collect_list(F.struct("score", "rank", "id"))).alias("results")
    )


def rendered(hits: DataFrame, decimals: int | None = None) -> DataFrame:
    """(query_id, query, text): the query, then a line ``  rank:id score title`` per hit.

    Scores print in full, or with a fixed number of ``decimals``.
    """
    score = F.col("score").cast("string") if decimals is None else F.format_string(f"%.{decimals}f", "score")
    line = F.concat(
        F.lit("  "), F.col("rank").cast("string"), F.lit(":"), F.col("id"), F.lit(" "), score, F.lit(" "), F.col("title")
    )
    lines = hits.select("query_id", "query", F.struct("rank", line.alias("line")).alias("placed"))
    in_order = F.transform(F.array_sort(F.collect_list("placed")), lambda p: p["line"])
    return lines.groupBy("query_id", "query").agg(in_order.alias("lines")).select(
        "query_id",
        "query",
        F.concat(F.array_join(F.concat(F.array("query"), F.col("lines")), "\n"), F.lit("\n")).alias("text"),
    )
