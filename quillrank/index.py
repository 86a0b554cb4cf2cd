"""A corpus index that outlives one call: articles are analysed once, any number of rankings read what was found."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillrank.operators.bags import token_store

_ENTRY = T.StructType([T.StructField("token", T.StringType()), T.StructField("tf", T.IntegerType())])

INDEX = T.StructType([
    T.StructField("fingerprint", T.BinaryType()),
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("entries", T.ArrayType(_ENTRY)),
])


@dataclass(frozen=True)
class ArticleIndex:
    """The token store of a corpus, to be given to ``rank_documents`` in place of its articles."""

    rows: DataFrame


def write_index(articles: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Analyse ``articles`` and store what every ranking needs of them; with mode ``append``, more articles join an index."""
    token_store(articles).write.mode(mode).parquet(path)


def read_index(spark: SparkSession, path: str) -> ArticleIndex:
    return ArticleIndex(spark.read.schema(INDEX).parquet(path))
