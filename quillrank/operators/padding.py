"""Filling short rankings with candidates of score 0, lowest ids first, without offering all candidates to all queries.

Candidates are numbered in their order. A query that has m scored candidates finds K others among the first K + m, so it is offered
these numbers and no more: numbers meet candidates in an equi join, and an anti join takes out what the query scored.
"""

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.operators import selection
from quillrank.operators.bags import CANDIDATE
from quillrank.operators.numbering import numbered
from quillrank.storage import Scratch, broadcast_if_small

if TYPE_CHECKING:
    from quillrank.plans.retrieval import Corpus

_GROWTH = 4
_RUN = 10_000  # numbers that are made from one row at a time
_NUMBER_ROWS, _NUMBER_BYTES = 1_000_000, 32


def scored_pairs(corpus: "Corpus", held: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, fingerprint) of the candidates that score other than 0, for each of the ``queries`` (query_id).

    Only for queries of which not all hits are ``held`` articles are scored again.
    """
    own = held.join(queries, "query_id", "left_semi")
    cut = own.where("not whole").select("query_id").distinct()
    pairs = own.where("whole and score <> 0").select("query_id", "fingerprint")
    if cut.isEmpty():
        return pairs
    return pairs.union(corpus.hits(cut).where("score <> 0").select("query_id", "fingerprint"))


def offers(ranges: DataFrame) -> DataFrame:
    """(query_id, number): every whole number of each range (query_id, start, end), ends included, made in short runs."""
    runs = ranges.where("start <= end").select(
        "query_id", "end", F.explode(F.sequence("start", "end", F.lit(_RUN).cast("bigint"))).alias("first")
    )
    last = F.least(F.col("first") + F.lit(_RUN - 1), F.col("end"))
    return runs.select("query_id", F.explode(F.sequence("first", last)).alias("number"))


def _up_to(total: int, end: Column) -> Column:
    return F.least(end, F.lit(total)).cast("bigint")


def zero_hits(
    candidates: DataFrame, total: int, pairs: DataFrame, queries: DataFrame, count: int, scratch: Scratch
) -> Iterator[DataFrame]:
    """Hits of score 0 of the ``queries``, lowest numbers first, in frames that each go on where the last one ended.

    ``candidates`` have a ``number`` from 1 to ``total``. The first frame offers ``count`` numbers to a query besides as many as it has ``pairs``,
    the next ones four times as many each time, until all are offered.
    """
    matched = pairs.groupBy("query_id").agg(F.count("*").alias("matched"))
    size = F.lit(count) + F.coalesce("matched", F.lit(0))
    ranges = scratch.stored(queries.join(matched, "query_id", "left").select(
        "query_id", F.lit(1).cast("bigint").alias("start"), _up_to(total, size).alias("end")
    ))
    while True:
        bounds = ranges.where("start <= end").agg(F.min("start").alias("least"), F.max("end").alias("most")).first()
        if bounds["least"] is None:
            return
        numbers = broadcast_if_small(scratch.stored(offers(ranges)), F.lit(_NUMBER_BYTES), _NUMBER_ROWS, _NUMBER_ROWS * _NUMBER_BYTES)
        offered = candidates.where(F.col("number").between(bounds["least"], bounds["most"])).join(numbers, "number")
        zeros = offered.join(pairs, ["query_id", "fingerprint"], "left_anti").drop("number")
        yield scratch.stored(zeros.withColumn("score", F.lit(0.0)))
        count *= _GROWTH
        ranges = ranges.select(
            "query_id", (F.col("end") + 1).alias("start"), _up_to(total, F.col("end") + F.lit(count)).alias("end")
        )


def choose_zeros(
    corpus: "Corpus", held: DataFrame, choice: DataFrame, k: int, prefix: int, dedup: bool, scratch: Scratch
) -> tuple[DataFrame, bool]:
    """Fill up what queries lack of ``k`` with candidates of score 0; whether any is still short."""
    first, _ = selection.prefix_lengths(k, prefix)
    queries = scratch.stored(choice.where(F.size("kept") < k).select("query_id"))
    pairs = scratch.stored(scored_pairs(corpus, held, queries))
    candidates, total = numbered(corpus.bags.select(*CANDIDATE, "copies"), CANDIDATE)
    # Edit distances take long for the few bytes they read, and so few are read by few tasks.
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = True
    for zeros in zero_hits(candidates, total, pairs, queries, first, scratch):
        wanting = scratch.stored(selection.next_stretch(choice, k))
        choice, short = selection.choose(
            wanting, lambda asked, zeros=zeros: zeros.join(asked, "query_id", "left_semi").repartition(tasks),
            k, dedup, scratch, prefix,
        )
        if not short:
            break
    return choice, short
