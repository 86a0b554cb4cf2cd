"""Scores of candidates: postings meet query terms on the term, never queries on documents."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions.relevance import dph, rarity
from quillrank.operators.bags import CANDIDATE
from quillrank.storage import kept

# Fixed values of scoring all hits: sums that one task holds, rows of weights that it holds (16 bytes each), and tasks in all; with
# more to do than these can hold a task spills, but the driver, which keeps about 2 KB for each, stays small.
ROWS_A_TASK = 2_000_000
WEIGHTS_A_TASK = 4_000_000
MOST_TASKS = 32_000


def term_weights(terms: DataFrame, frequencies: DataFrame, stats: DataFrame, ratio: str) -> DataFrame:
    """``terms`` with what scoring needs to know of each: cf, rarity and the mean length.

    A term the corpus does not have gets cf 0 and a null rarity.
    """
    n_docs = stats.select("n_docs").scalar()
    avg_len = stats.select("avg_len").scalar()
    return (
        terms.join(frequencies, "term", "left")
        .withColumn("cf", F.coalesce("cf", F.lit(0)))
        .withColumn("rarity", rarity(n_docs, F.col("cf"), ratio))
        .withColumn("avg_len", avg_len)
    )


def term_score() -> Column:
    """The score of a term in an article, from the columns that postings and weights bring."""
    return dph(F.col("tf"), F.col("length"), F.col("avg_len"), F.col("rarity"))


def term_scores(postings: DataFrame, weights: DataFrame) -> DataFrame:
    """``postings`` joined with ``weights`` on the term, with the score of the term in the article."""
    return postings.join(weights, "term").withColumn("term_score", term_score())


def scored_hits(postings: DataFrame, weights: DataFrame, keys: list[str] = CANDIDATE) -> DataFrame:
    """(query_id, keys, copies, score): every candidate that has a term of the query.

    The mean of the term scores over the term occurrences of the query; a repeated term counts
    again each time. With ``weights`` broadcast and ``postings`` partitioned by ``keys`` there is
    no shuffle.
    """
    total = F.sum(F.col("qtf") * F.col("term_score"))
    return (
        term_scores(postings, weights)
        .groupBy(*keys, "copies", "query_id", "n_terms")
        .agg(total.alias("total"))
        # Adding 0.0 turns -0.0 into 0.0.
        .select("query_id", *keys, "copies", (F.col("total") / F.col("n_terms") + 0.0).alias("score"))
    )


def _term_index(weights: DataFrame, groups: int) -> DataFrame:
    """(part, term, rarity, avg_len, query_id, n_terms, qtf): a row per term and group of queries, with an array element for each query that has it.

    In arrays a weight takes 16 bytes, so millions of them go through the driver to the tasks as one small table.
    """
    part = F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("part")
    one = F.struct("query_id", F.col("n_terms").cast("int").alias("n_terms"), F.col("qtf").cast("int").alias("qtf"))
    rows = weights.groupBy(part, "term", "rarity", "avg_len").agg(F.collect_list(one).alias("all"))
    return rows.select("part", "term", "rarity", "avg_len", "all.query_id", "all.n_terms", "all.qtf")


def tasks_of_all_hits(partitions: int, groups: int, articles: int, queries: int, occurrences: int) -> int:
    """Tasks for each of so many groups of queries: enough to hold their sums, one for each article and query at most, but not over ``MOST_TASKS`` in all."""
    sums = min(occurrences, articles * queries)
    return max(min(partitions, MOST_TASKS // groups), min(-(-sums // (ROWS_A_TASK * groups)), MOST_TASKS // groups), 1)


def all_hits(articles: DataFrame, weights: DataFrame) -> DataFrame:
    """(query_id, id, score): every hit of every query, computed when it is read; nothing that is written or shuffled grows with the hits.

    ``articles`` are distinct ones, as ``bags.once_each`` gives them, ``weights`` those of their terms, both stored. Articles are dealt once, to so many
    tasks that each can add up its scores in memory. Queries go by groups whose weights can be broadcast, as arrays by term: a term is scored once in an
    article, then added for each query that has it.
    """
    spark = articles.sparkSession
    size = weights.agg(F.sum("cf").alias("rows"), F.count("*").alias("weights"), F.countDistinct("query_id").alias("queries")).first()
    groups = max(1, -(-size["weights"] // WEIGHTS_A_TASK))
    tasks = tasks_of_all_hits(
        int(spark.conf.get("spark.sql.shuffle.partitions")), groups, articles.count(), size["queries"] + 1, size["rows"] or 0
    )
    index = kept(_term_index(weights, groups))
    # A task tells its articles apart by their place in it, not by fingerprints: the keys of a sum are numbers and the id.
    dealt = articles.select(F.xxhash64("fingerprint").alias("hash"), "id", "length", "entries").repartition(tasks, "hash")
    keys = ["hash", "place", "id"]
    entries = dealt.withColumn("place", F.monotonically_increasing_id()).select(
        *keys, "length", F.explode("entries").alias("entry")
    ).select(*keys, "length", F.col("entry.token").alias("term"), F.col("entry.tf").cast("bigint").alias("tf"))
    parts = [_hits_by_index(entries, index.where(F.col("part") == i), keys) for i in range(groups)]
    return reduce(DataFrame.union, parts).select("query_id", "id", "score")


def _hits_by_index(entries: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """(query_id, keys, score): the hits of the queries in one part of an index."""
    found = entries.join(F.broadcast(index), "term").withColumn("term_score", term_score())
    # Named by the generator, the score is computed before it, not once more for each query.
    each = found.select(
        *keys, "term_score", "query_id", "n_terms", F.posexplode(F.when(F.col("term_score").isNotNull(), F.col("qtf"))).alias("at", "times")
    )
    rows = each.select(*keys, F.get("query_id", "at").alias("query_id"), F.get("n_terms", "at").alias("n_terms"), "times", "term_score")
    total = F.sum(F.col("times") * F.col("term_score"))
    return rows.groupBy(*keys, "query_id", "n_terms").agg(total.alias("total")).select(
        "query_id", *keys, (F.col("total") / F.col("n_terms") + 0.0).alias("score")
    )
