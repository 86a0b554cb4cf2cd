"""The best hits of very many queries, added up by blocks of articles in numpy.

With many queries nearly every article has terms of each of them: the rows of (article, query, term) are billions where articles are thousands, and what takes
time is to make and group such rows. Here Spark makes a row per article and term, with the score of the term, and sums are made in
Python workers, article by article, in dense blocks of scores. The index of the queries travels with the function, about 12 bytes for each
term of a query. Only hits that reach a floor, which a sample of the articles gives each query, leave a task: as a query, a slot and a score. A slot
is a number of the article, in the order in which equal scores rank. Titles join what is walked, a stretch at a time.
"""

from collections.abc import Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.functions import adding
from quillrank.functions.relevance import merit
from quillrank.functions.titles import title_profile
from quillrank.functions.walking import kept_places
from quillrank.operators import bags, scoring, selection
from quillrank.operators.bags import CANDIDATE
from quillrank.operators.numbering import numbered
from quillrank.storage import Scratch

LEAST_TERMS = 20_000  # terms of all queries; with fewer the JVM's rows cost less than a worker's start
LEAST_ROWS = 20_000_000  # (article, query, term) rows, or more
MOST_WEIGHTS = 4_000_000  # what may travel as an index, 12 bytes each

SAMPLE = 4  # one in so many articles is scored for the floors
_GROWTH = 4  # each stretch of a walk goes so many times as far as the one before
_MOST_TOPS = 20_000_000  # best scores of queries that a worker keeps; with more there are no floors
_FIRST_ZEROS, _MOST_ZEROS = 256, 65_536  # articles that are offered with score 0 at first; beyond so many all the others are

_SCORED = "query_id bigint, slot bigint, score double"


class Scored:
    """The articles of a token store with slots, and the index of the queries (query_id, n_terms) with their ``weights``.

    Tokens are their own terms. Queries without weights have an article's score of 0 everywhere, those without a number no score.
    """

    def __init__(self, store: DataFrame, queries: DataFrame, weights: DataFrame, scratch: Scratch):
        self._store, self._scratch = store, scratch
        terms, count = numbered(weights.select("term", "rarity", "avg_len").distinct(), ["term"])
        self._terms = F.broadcast(scratch.stored(terms.withColumn("number", (F.col("number") - 1).cast("int"))))
        sizes = queries.where(F.col("query_id").isNotNull()).toArrow()
        ids = sizes.column("query_id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        found = weights.select("query_id", "term", "qtf").join(self._terms, "term").select("query_id", "number", "qtf")
        found = found.where(F.col("query_id").isNotNull()).toArrow()
        self._index = adding.QueryIndex.of(
            found.column("number").to_numpy(), np.searchsorted(ids, found.column("query_id").to_numpy()),
            found.column("qtf").to_numpy(), count, ids, sizes.column("n_terms").to_numpy()[order],
        )

    @cached_property
    def articles(self) -> DataFrame:
        """(slot, CANDIDATE, copies, profile, entries), equal articles once. Slots follow the order of candidates."""
        rows = bags.counted_once(self._store)
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = rows.repartitionByRange(tasks, *CANDIDATE).sortWithinPartitions(*CANDIDATE)
        return self._scratch.stored(placed.select(
            F.monotonically_increasing_id().alias("slot"), *CANDIDATE, "copies", title_profile(F.col("title")).alias("profile"), "entries"
        ))

    def _postings(self, condition: Column | None) -> DataFrame:
        """(slot, number, term_score): those of an article stand together, for explode and the join keep the order of a task."""
        articles = self.articles if condition is None else self.articles.where(condition)
        entries = articles.select("slot", "length", F.explode("entries").alias("entry")).select(
            "slot", "length", F.col("entry.token").alias("term"), F.col("entry.tf").cast("bigint").alias("tf")
        )
        return entries.join(self._terms, "term").select("slot", "number", scoring.term_score().alias("term_score"))

    def _only(self, queries: DataFrame | None) -> adding.QueryIndex:
        if queries is None:
            return self._index
        wanted = queries.select("query_id").where(F.col("query_id").isNotNull()).toArrow().column("query_id").to_numpy()
        return self._index.only(np.isin(self._index.ids, wanted))

    def where(self, score: str, queries: DataFrame, condition: Column | None = None) -> DataFrame:
        """(query_id, slot, score) of the articles whose score is ``zero`` or ``under``, for the ``queries`` (query_id)."""
        return self._postings(condition).mapInArrow(adding.hits_where(self._only(queries), score), _SCORED)

    def best(self, count: int, queries: DataFrame | None = None) -> DataFrame:
        """(query_id, slot, score, position): the best ``count`` hits over 0 of every query, or of the ``queries`` (query_id), stored."""
        index = self._only(queries)
        floors = np.zeros(len(index.ids))
        if count * len(index.ids) <= _MOST_TOPS:
            sample = self._postings(F.pmod(F.xxhash64("slot"), F.lit(SAMPLE)) == 0)
            tops = sample.mapInArrow(adding.best_of_tasks(index, count), "query_id bigint, best array<double>")
            merged = tops.groupBy("query_id").agg(F.sort_array(F.flatten(F.collect_list("best")), asc=False).alias("best"))
            known = merged.select("query_id", F.get("best", F.lit(count - 1)).alias("floor")).where("floor is not null").toArrow()
            floors[np.searchsorted(index.ids, known.column("query_id").to_numpy())] = known.column("floor").to_numpy()
        hits = self._postings(None).mapInArrow(adding.hits_from(index, floors, count), _SCORED)
        return self._scratch.stored(ranked(hits).where(F.col("position") <= count))

    def titled(self, hits: DataFrame) -> DataFrame:
        """``hits`` with what ``selection`` walks by."""
        rows = hits.join(self.articles.drop("entries"), "slot").drop("slot")
        return rows.withColumn("demerit", -merit(F.col("score")))


def ranked(hits: DataFrame) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc(merit(F.col("score"))), "slot")
    return hits.withColumn("position", F.row_number().over(order))


def fold(kept: Column, walked: Column, k: int) -> Column:
    """``kept`` and what of ``walked`` is kept besides; the same as ``selection`` folds, with distances taken in Python workers."""
    title = lambda hits: F.transform(hits, lambda hit: hit["title"])
    have = F.when(F.size(walked) > 0, title(kept)).otherwise(F.array().cast("array<string>"))
    places = kept_places(have, title(walked), F.lit(k))
    return F.concat(kept, F.transform(places, lambda place: F.get(walked, place)))


def _short(choice: DataFrame, k: int) -> DataFrame:
    return choice.where(F.size("kept") < k).select("query_id")


def _walk(choice: DataFrame, hits: DataFrame, scored: Scored, k: int, dedup: bool, scratch: Scratch, first: int) -> tuple[DataFrame, bool]:
    """``choice`` after its short queries walked down their ``hits``, a stored table with positions; whether any query is still short.

    Stretches grow, so a query that finds what it wants soon moves few titles. Copies of kept titles do not move.
    """
    start, end = 0, first
    while True:
        wanting = choice.where(F.size("kept") < k).select("query_id", F.transform("kept", lambda hit: hit["title"]).alias("have"))
        stretch = hits.where((F.col("position") > start) & (F.col("position") <= end))
        found = scored.titled(stretch.join(wanting, "query_id"))
        if dedup:
            found = found.where((F.col("title") == "") | ~F.array_contains("have", F.col("title")))
        walked = selection.walked(choice, found.drop("have"), k, dedup, fold=fold if dedup else None)
        choice = scratch.stored(walked.select("query_id", "kept"))
        if choice.where(F.size("kept") < k).isEmpty():
            return choice, False
        if hits.where(F.col("position") > end).join(_short(choice, k), "query_id", "left_semi").isEmpty():
            return choice, True
        start, end = end, end * _GROWTH


def _offered(scored: Scored) -> Iterator[Column]:
    """Conditions on slots: a few of the first, then more, then all the others."""
    start, count = -1, _FIRST_ZEROS
    while True:
        later = scored.articles.where(F.col("slot") > start).select("slot")
        if count > _MOST_ZEROS:
            yield F.col("slot") > start
            return
        end = later.orderBy("slot").limit(count).agg(F.max("slot").alias("end")).first()["end"]
        if end is None:
            return
        yield (F.col("slot") > start) & (F.col("slot") <= end)
        start, count = end, count * _GROWTH * _GROWTH


def choose(scored: Scored, choice: DataFrame, k: int, prefix: int, dedup: bool, scratch: Scratch) -> DataFrame:
    """The hits that every query keeps: those over 0, then articles that score 0, then those under 0."""
    count, _ = selection.prefix_lengths(k, prefix)
    first = min(2 * k, count)
    best = scored.best(count)
    choice, short = _walk(choice, best, scored, k, dedup, scratch, first)
    while short:
        used_up = best.where(F.col("position") == count).join(_short(choice, k), "query_id", "left_semi").select("query_id")
        if used_up.isEmpty():
            break
        best = scored.best(count * _GROWTH, used_up)
        beyond = best.where(F.col("position") > count).withColumn("position", F.col("position") - count)
        choice, short = _walk(choice, beyond, scored, k, dedup, scratch, count)
        count *= _GROWTH
    if short:
        for condition in _offered(scored):
            zeros = scratch.stored(ranked(scored.where("zero", _short(choice, k), condition)))
            choice, short = _walk(choice, zeros, scored, k, dedup, scratch, first)
            if not short:
                break
    if short:
        under = scratch.stored(ranked(scored.where("under", _short(choice, k))))
        choice, _ = _walk(choice, under, scored, k, dedup, scratch, first)
    return choice
