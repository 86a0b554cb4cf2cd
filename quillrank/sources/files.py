"""Reading queries and articles from files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrank.schema import ARTICLE

_CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(path)


def read_queries(spark: SparkSession, path: str, numbers: str = "position") -> DataFrame:
    """One query per line, numbered by ``position`` or by ``text``.

    Positions rise in file order; they are stable for given files, but not if these are written anew in other splits. By text a number is a
    hash of the line, the same wherever it stands; equal lines are one query then.
    """
    lines = read_lines(spark, path).withColumnRenamed("value", "query")
    if numbers == "position":
        return lines.select(F.monotonically_increasing_id().alias("query_id"), "query")
    if numbers == "text":
        return lines.distinct().select(F.xxhash64("query").alias("query_id"), "query")
    raise ValueError(f"numbers must be 'position' or 'text', not {numbers!r}")


def _article_schema(mode: str) -> T.StructType:
    """The article schema, with room for the raw line of a malformed article if it is kept."""
    if mode == "PERMISSIVE":
        return T.StructType([*ARTICLE.fields, T.StructField(_CORRUPT, T.StringType())])
    return ARTICLE


def read_articles(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines, one article each. Only the fields a plan uses are decoded.

    ``FAILFAST`` fails the job on a malformed line, ``PERMISSIVE`` keeps the line in
    ``_corrupt_record``, ``DROPMALFORMED`` drops it. Unknown fields are ignored.
    """
    return spark.read.schema(_article_schema(mode)).option("mode", mode).json(path)


def _without_unknown_fields(line: Column) -> Column:
    known = F.array(*[F.lit(name) for name in ARTICLE.fieldNames()])
    unknown = F.array_except(F.json_object_keys(line), known)
    message = F.concat(F.lit("unknown article fields: "), F.array_join(unknown, ", "))
    return F.when(F.size(unknown) > 0, F.raise_error(message)).otherwise(line)


def parse_articles(lines: DataFrame, mode: str = "FAILFAST", unknown_fields: str = "ignore") -> DataFrame:
    """Articles from lines already read, in column ``value``.

    ``unknown_fields="fail"`` fails the job on a top-level field that no article has; fields
    inside ``contents`` are free.
    """
    line = F.col("value")
    if unknown_fields == "fail":
        line = _without_unknown_fields(line)
    elif unknown_fields != "ignore":
        raise ValueError(f"unknown_fields must be 'ignore' or 'fail', not {unknown_fields!r}")
    options = {"mode": mode}
    if mode == "PERMISSIVE":
        options["columnNameOfCorruptRecord"] = _CORRUPT
    return lines.select(F.from_json(line, _article_schema(mode), options).alias("article")).select("article.*")


def with_published_at(articles: DataFrame) -> DataFrame:
    """Adds ``published_at``, the publication time as a timestamp."""
    return articles.withColumn("published_at", F.timestamp_millis("published_date"))
