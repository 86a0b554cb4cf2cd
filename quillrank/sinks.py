"""Writing rankings. Every executor writes the queries it holds; nothing passes the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.operators.assembly import rendered


def file_name(query):
    """The query with ``_`` for every space."""
    return F.replace(query, F.lit(" "), F.lit("_"))


def write_rendered(hits: DataFrame, path: str, mode: str = "errorifexists", per_query: bool = True) -> None:
    """One text file per query, in ``query_id=<id>/``. Equal queries and any character are safe.

    Without ``per_query`` the rankings of many queries follow each other in a file, in the order of their numbers: as few files as
    their size asks for, however many queries there are.
    """
    texts = rendered(hits).select("query_id", F.regexp_replace("text", "\n$", "").alias("text"))
    if per_query:
        texts.write.mode(mode).partitionBy("query_id").text(path)
    else:
        texts.repartitionByRange("query_id").sortWithinPartitions("query_id").select("text").write.mode(mode).text(path)


def write_hits(hits: DataFrame, path: str, file_format: str = "parquet", mode: str = "errorifexists") -> None:
    """The hits, with the file name that their query would have, in ``query_id=<id>/``."""
    named = hits.withColumn("file_name", file_name(F.col("query")))
    named.write.mode(mode).partitionBy("query_id").format(file_format).save(path)
