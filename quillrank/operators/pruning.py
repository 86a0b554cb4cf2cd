"""The best hits of queries without scoring every article that has any of their terms.

A sample of the articles, scored in full, gives each query a floor: so many of its hits are at least that good. No term adds more to a score than its
best score in any article. So of the terms of a query those that matter least cannot reach the floor, all together: an article that has none of
the other, essential ones is not worth scoring. Articles are scored by their essential terms first; where even the most of
the others would leave them under the floor they are dropped, and only for the rest the scores are completed. Term scores add up
without rounding, so the hits at the floor or above are exactly those of full scoring.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.functions.relevance import merit
from quillrank.operators import bags, scoring
from quillrank.storage import Scratch, broadcast_if_small

SAMPLE = 8  # one in so many articles is scored for the floors
LEAST_ROWS = 2_000_000  # with fewer (article, query, term) rows to score, the extra passes cost more than they spare
_FLOOR_ROWS, _FLOOR_BYTES = 1_000_000, 32 << 20


def rows_to_score(weights: DataFrame) -> int:
    """How many (article, query, term) rows full scoring makes, or more: occurrences of terms, once per query that has them."""
    return weights.agg(F.sum("cf").alias("rows")).first()["rows"] or 0


def _in_sample() -> Column:
    return F.pmod(F.xxhash64("fingerprint"), F.lit(SAMPLE)) == 0


def floors(bag_rows: DataFrame, weights: DataFrame, count: int) -> DataFrame:
    """(query_id, floor): the score of the ``count``-th best hit in the sample, for queries that have as many there."""
    keys = ["fingerprint", "length"]
    hits = scoring.scored_hits(bags.postings(bag_rows.where(_in_sample()), keys), weights, keys)
    order = Window.partitionBy("query_id").orderBy(F.desc("value"))
    ranked = hits.select("query_id", merit(F.col("score")).alias("value")).withColumn("nth", F.row_number().over(order))
    return ranked.where(F.col("nth") <= count).where(F.col("nth") == count).select("query_id", F.col("value").alias("floor"))


def bounded(postings: DataFrame, weights: DataFrame, floor: DataFrame) -> DataFrame:
    """``weights`` with ``floor``, ``least``, ``essential`` and ``rest``.

    ``least`` is the floor before the division by the terms of the query, a trifle lower so that rounding cannot lift it over a hit;
    ``rest`` the most that the terms which are not essential add together.
    """
    stats = F.broadcast(weights.select("term", "rarity", "avg_len").distinct())  # no larger than the weights
    best = scoring.term_scores(postings, stats).groupBy("term").agg(F.max(merit(F.col("term_score"))).alias("best"))
    most = F.greatest(F.col("qtf") * F.col("best"), F.lit(0.0))
    known = weights.join(best, "term").join(floor, "query_id", "left").withColumn("most", most)
    ascending = Window.partitionBy("query_id").orderBy("most", "term")
    total = F.col("floor") * F.col("n_terms")
    reached = known.withColumn("reached", F.sum("most").over(ascending)).withColumn("least", total - F.abs(total) * 1e-12)
    # A term is needed unless it and all lesser ones stay under the floor.
    marked = reached.withColumn("essential", F.col("least").isNull() | (F.col("reached") >= F.col("least")))
    others = F.sum(F.when(F.col("essential"), 0.0).otherwise(F.col("most"))).over(Window.partitionBy("query_id"))
    return marked.withColumn("rest", others).drop("best", "most", "reached")


def _pays(bag_rows: DataFrame, marked: DataFrame) -> bool:
    """Whether essential terms first is less work than all terms at once.

    An article that has essential terms may have its whole bag read again for the others.
    """
    rows = marked.agg(F.sum(F.when(F.col("essential"), F.col("cf"))).alias("essential"), F.sum("cf").alias("all")).first()
    bag = bag_rows.agg(F.avg(F.size("bag")).alias("size")).first()["size"] or 0
    return (rows["essential"] or 0) * (1 + bag) < (rows["all"] or 0)


def _completed_hits(bag_rows: DataFrame, marked: DataFrame) -> DataFrame:
    """(query_id, fingerprint, score, floor): hits by their essential terms, completed for those that may reach the floor."""
    essential, others = (F.broadcast(marked.where(c)) for c in ("essential", "not essential"))
    keys = ["fingerprint", "length", "query_id", "n_terms", "floor", "least", "rest"]
    found = scoring.term_scores(bags.postings(bag_rows, ["fingerprint", "length"]), essential)
    found = found.groupBy(*keys).agg(F.sum(F.col("qtf") * F.col("term_score")).alias("total"))
    worth = found.where(F.col("least").isNull() | (F.col("total") + F.col("rest") >= F.col("least")))
    # Articles meet their own bags again; both sides are dealt by fingerprint.
    entries = worth.join(bag_rows.select("fingerprint", "bag"), "fingerprint").select(
        *keys, "total", F.explode("bag").alias("entry")
    ).select(*keys, "total", F.col("entry.token").alias("term"), F.col("entry.tf").alias("tf"))
    completed = entries.join(others.drop("n_terms", "floor", "least", "rest"), ["query_id", "term"], "left")
    added = F.when(F.col("qtf").isNotNull(), F.col("qtf") * scoring.term_score()).otherwise(0.0)
    totals = completed.groupBy(*keys, "total").agg((F.col("total") + F.sum(added)).alias("sum"))
    score = (F.col("sum") / F.col("n_terms") + 0.0).alias("score")
    return totals.select("query_id", "fingerprint", score, "floor")


def pruned_hits(bag_rows: DataFrame, weights: DataFrame, count: int, scratch: Scratch) -> DataFrame:
    """(query_id, CANDIDATE, copies, score, floor): for every query at least all hits that score its floor or more.

    ``floor`` is null for queries that have fewer than ``count`` hits in the sample: these have all of their hits. Others have
    ``count`` hits at the floor or above. ``bag_rows`` are dealt by fingerprint, ``weights`` are of a size to be broadcast.
    """
    floor = scratch.stored(floors(bag_rows, weights, count))
    marked = scratch.stored(bounded(bags.postings(bag_rows, ["fingerprint", "length"]), weights, floor))
    if _pays(bag_rows, marked):
        hits = _completed_hits(bag_rows, marked)
    else:
        keys = ["fingerprint", "length"]
        hits = scoring.scored_hits(bags.postings(bag_rows, keys), weights, keys)
        hits = hits.join(F.broadcast(floor), "query_id", "left").select("query_id", "fingerprint", "score", "floor")
    # Titles can be as long as texts: until few hits are left, the fingerprint alone stands for an article.
    hits = hits.where(F.col("floor").isNull() | (merit(F.col("score")) >= F.col("floor")))
    return hits.join(bag_rows.select(*bags.CANDIDATE, "copies"), "fingerprint").select(
        "query_id", *bags.CANDIDATE, "copies", "score", "floor"
    )
