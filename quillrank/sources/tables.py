"""Articles and queries made from parquet tables of texts, web pages and conversations."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrank.operators.analysis import PARAGRAPHS
from quillrank.schema import ARTICLE, CONTENT_ITEM

# Fixed values, also used by the SQL that checks these adapters.
HTML_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
HTML_HIDDEN = r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>"
HTML_PARAGRAPH_START = r"(?i)<p(?:\s[^>]*)?>"
HTML_PARAGRAPH_END = r"(?is)(?:</p>|</article>|</body>).*"
HTML_TAG = r"(?s)<[^>]*>"
TURN_BITS = 32
HTML_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&amp;": "&"}


def _paragraphs(texts: Column) -> Column:
    """Content blocks of subtype ``paragraph``, one per text; the other block fields are null."""
    given = {"content": lambda text: text, "subtype": lambda text: F.lit("paragraph")}

    def block(text: Column) -> Column:
        return F.struct(*[
            given.get(name, lambda _: F.lit(None).cast("string"))(text).alias(name)
            for name in CONTENT_ITEM.fieldNames()
        ])

    return F.transform(texts, block)


def _as_articles(df: DataFrame, **given: Column) -> DataFrame:
    """Selects the article columns; those not given are null."""
    return df.select(*[
        given.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in ARTICLE
    ])


def documents_as_articles(documents: DataFrame) -> DataFrame:
    """The first line is the title, every other line that is not empty a paragraph."""
    lines = F.split("text", "\n")
    rest = F.filter(lines, lambda line, i: (i > 0) & (line != ""))
    return _as_articles(
        documents,
        id=F.col("doc_id"),
        title=F.get(lines, 0),
        contents=_paragraphs(rest),
        source=F.col("source"),
    )


def _unescaped(text: Column) -> Column:
    for entity, character in HTML_ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def pages_as_articles(pages: DataFrame) -> DataFrame:
    """The page title and the text of every ``<p>`` block, up to its end or the next ``<p>``."""
    blocks = F.split(F.regexp_replace("html", HTML_HIDDEN, " "), HTML_PARAGRAPH_START)
    inside = F.filter(blocks, lambda block, i: i > 0)
    texts = F.transform(
        inside,
        lambda block: _unescaped(
            F.regexp_replace(F.regexp_replace(block, HTML_PARAGRAPH_END, ""), HTML_TAG, " ")
        ),
    )
    return _as_articles(
        pages,
        id=F.col("page_id"),
        article_url=F.col("url"),
        title=_unescaped(F.regexp_extract("html", HTML_TITLE, 1)),
        contents=_paragraphs(texts),
    )


def conversations_as_articles(conversations: DataFrame) -> DataFrame:
    """A conversation is an article; its turn 3, if there is one, is the title, and its turns are blocks.

    Turns of users and assistants are paragraphs, others keep their role as subtype. Of the paragraphs with content only
    those that are indexed are taken, the first ones, and as many other blocks: Spark cuts both before the shuffle, so no row
    grows with its conversation.
    """
    speaks = F.col("role").isin("user", "assistant")
    order = Window.partitionBy("conv_id", "usable").orderBy("turn", "role", "text")
    first = (
        conversations.select("conv_id", "turn", "role", "text", F.coalesce(speaks & F.col("text").isNotNull(), F.lit(False)).alias("usable"))
        .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= PARAGRAPHS)
    )
    given = {
        "content": lambda turn: turn["text"],
        "subtype": lambda turn: F.when(turn["role"].isin("user", "assistant"), "paragraph").otherwise(turn["role"]),
    }
    blocks = lambda turn: F.struct(*[
        given.get(name, lambda _: F.lit(None))(turn).cast("string").alias(name) for name in CONTENT_ITEM.fieldNames()
    ])
    grouped = first.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    titles = conversations.where("turn = 3").groupBy("conv_id").agg(F.max("text").alias("title"))
    joined = grouped.join(titles, "conv_id", "left")
    return _as_articles(joined, id=F.col("conv_id"), title=F.col("title"), contents=F.transform("turns", blocks))


def user_turns_as_queries(conversations: DataFrame) -> DataFrame:
    """Every turn of a user is a query; its number has the conversation above ``TURN_BITS``, the turn below."""
    return conversations.where(F.col("role") == "user").select(
        (F.shiftleft("conv_id", TURN_BITS) + F.col("turn")).alias("query_id"),
        F.col("text").alias("query"),
    )


def benchmark_as_queries(benchmark: DataFrame) -> DataFrame:
    """Every item, in full, is a long query."""
    return benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")
