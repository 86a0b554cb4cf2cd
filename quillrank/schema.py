"""Schemas of the tables that enter and leave the engine."""

from pyspark.sql import types as T

_CONTENT_FIELDS = [
    "content", "subtype", "type", "mime",
    "fullcaption", "imageURL", "imageHeight", "imageWidth", "blurb",
    "role", "name", "bio",
    "kicker",
]

CONTENT_ITEM = T.StructType([T.StructField(name, T.StringType()) for name in _CONTENT_FIELDS])

ARTICLE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("article_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published_date", T.LongType()),
    T.StructField("contents", T.ArrayType(CONTENT_ITEM)),
    T.StructField("type", T.StringType()),
    T.StructField("source", T.StringType()),
])

QUERY = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("query", T.StringType()),
])

# One row per (query, rank): what rank_documents returns.
HIT = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("query", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("score", T.DoubleType()),
])
