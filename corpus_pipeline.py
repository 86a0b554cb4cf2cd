"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm import exactdedup, oddsketch, packing, pii, quality
from quillrank.sources.tables import read_table
from quillrank.storage import Scratch, broadcast_if_small, checkpointed, short_batches

BATCH_ROWS = 1000  # texts that the last two stages send to a worker at a time

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Stages 2 and 5 have no SQL: the texts of stage 2 come from keyed hashes, the sequences of stage 5 from a greedy walk.
ORACLE_SQL: str | None = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these documents and the labels outside the held-out fold, accepts."""
    with Scratch(spark) as scratch:
        model = quality.fit(docs, read_table(spark, sf_dir, "labels"), scratch)
    return docs.where(quality.score_of("text", model) >= quality.REJECT_BELOW)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id."""
    return exactdedup.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near copies join the one with the least doc_id."""
    with Scratch(spark) as scratch:
        gone = oddsketch.near_groups(docs, scratch, percent=80).where("not kept").select("doc_id").distinct()
        gone = broadcast_if_small(checkpointed(gone), F.lit(16), 1_000_000, 16 << 20)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets exchanged for surrogates."""
    with Scratch(spark) as scratch, short_batches(spark, BATCH_ROWS):
        return checkpointed(pii.with_surrogates(docs, scratch).select(*docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 ids."""
    with Scratch(spark) as scratch, short_batches(spark, BATCH_ROWS):
        return checkpointed(packing.pack(docs, scratch, end_id=1))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("PII", with_surrogates),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other on ``documents``."""
    with Scratch(spark) as scratch:
        docs = read_table(spark, sf_dir, "documents")
        for _, stage in STAGES:
            docs = scratch.stored(stage(spark, docs, sf_dir))
        return checkpointed(docs)
