"""The whole ranking job, from queries and articles to the best hits of every query."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrank.functions.relevance import merit
from quillrank.index import ArticleIndex
from quillrank.operators import analysis, bags, blocks, padding, pruning, scoring, selection
from quillrank.storage import Scratch, broadcast_if_small, checkpointed

_TERM_BYTES = 64  # a row of numbers around a term
_WEIGHT_ROWS = 1_000_000
_WEIGHT_BYTES = 64 << 20


@dataclass(frozen=True)
class Options:
    """``k`` hits per query. ``stem``: compare Porter stems, not tokens. ``ratio``: documents per
    occurrence of a term, cut to an ``integer`` or ``real``. ``pad_zero``: articles that match
    only other queries rank with score 0. ``dedup``: drop near-duplicate titles."""

    k: int = 10
    stem: bool = True
    ratio: str = "integer"
    pad_zero: bool = True
    dedup: bool = True
    prefix: int = selection.PREFIX


class Corpus:
    """What the articles look like to one set of queries, in tables of ``scratch``.

    Articles are read and analysed once, into a token store, unless an index brings it; all else reads columns of it.
    """

    def __init__(self, queries: DataFrame, articles: DataFrame | ArticleIndex, options: Options, scratch: Scratch):
        self._ratio, self._scratch, self._options = options.ratio, scratch, options
        self.term_rows = scratch.stored(analysis.query_term_rows(queries, options.stem))
        self.store = articles.rows if isinstance(articles, ArticleIndex) else scratch.stored(bags.token_store(articles))
        vocabulary = analysis.query_vocabulary(self.term_rows)
        if options.stem:
            stems = analysis.stem_map(bags.corpus_tokens(self.store))
            token_terms = stems.join(vocabulary, "term", "left_semi")
        else:
            token_terms = vocabulary.select(F.col("term").alias("token"), "term")
        token_terms = scratch.stored(token_terms)
        self._token_terms = _small(token_terms, "token", _WEIGHT_ROWS, _WEIGHT_BYTES)
        self._tokens_are_small = self._token_terms is not token_terms
        self.stats = bags.corpus_stats(bags.article_lengths(self.store))

    @cached_property
    def bags(self) -> DataFrame:
        """The matches of every article, equal articles together."""
        # Adaptive execution may split frequent tokens here, if they do not fit a broadcast.
        found = self._scratch.stored(bags.matches(self.store, self._token_terms))
        return self._scratch.bucketed(bags.article_bags(self.store, found), "fingerprint")

    @cached_property
    def weights(self) -> DataFrame:
        """Every term of every query that the corpus has, with what scoring needs to know of it."""
        if self._may_add_blocks:
            frequencies = bags.store_frequencies(self.store, self._token_terms)
        else:
            frequencies = bags.term_frequencies(self.postings())
        counts = analysis.query_term_counts(self.term_rows)
        return self._scratch.stored(
            scoring.term_weights(counts, frequencies, self.stats, self._ratio).where("cf > 0")
        )

    @cached_property
    def _may_add_blocks(self) -> bool:
        """Whether there are many queries, of tokens, with all articles to rank after the hits."""
        options, rows = self._options, self.term_rows
        if options.stem or not options.pad_zero or rows.schema["query_id"].dataType != T.LongType():
            return False
        return self._tokens_are_small and rows.count() >= blocks.LEAST_TERMS

    def scored_by_blocks(self) -> blocks.Scored | None:
        """The articles as blocks of scores, if that pays; else None."""
        if not self._may_add_blocks or pruning.rows_to_score(self.weights) < blocks.LEAST_ROWS:
            return None
        queries = self.term_rows.select("query_id", "n_terms").distinct()
        numbers = queries.where(F.col("query_id").isNotNull()).agg(F.count("*").alias("rows"), F.countDistinct("query_id").alias("ids")).first()
        # Two queries of one number would need sums of their own.
        if numbers["rows"] != numbers["ids"] or self.weights.count() > blocks.MOST_WEIGHTS:
            return None
        return blocks.Scored(self.store, queries, self.weights, self._scratch)

    @cached_property
    def _small_weights(self) -> DataFrame:
        return _small(self.weights, "term", _WEIGHT_ROWS, _WEIGHT_BYTES)

    def postings(self) -> DataFrame:
        return bags.postings(self.bags)

    def hits(self, queries: DataFrame | None = None) -> DataFrame:
        """The scored hits of the given queries, or of all."""
        weights = self.weights
        if queries is not None:
            weights = weights.join(queries, "query_id", "left_semi")
        if self._small_weights is not self.weights:
            weights = F.broadcast(weights)  # part of a table whose size was checked
        return scoring.scored_hits(self.postings(), weights)

    def best_hits(self, count: int, most: int) -> DataFrame:
        """The best ``most`` hits of every query, or fewer that are ``count`` at least, as ``selection`` holds them.

        Where it pays, without scoring the articles that cannot be among the best ``count``.
        """
        hits = None
        if self._small_weights is not self.weights:
            if pruning.rows_to_score(self.weights) >= pruning.LEAST_ROWS:
                hits = pruning.pruned_hits(self.bags, self._small_weights, count, self._scratch)
        return self._scratch.stored(selection.best_hits(self.hits() if hits is None else hits, most))


def small_terms(terms: DataFrame, text: str) -> DataFrame:
    """A stored table of terms, hinted to be broadcast if it is small."""
    return _small(terms, text, _WEIGHT_ROWS, _WEIGHT_BYTES)


def _small(df: DataFrame, text: str, rows: int, size: int) -> DataFrame:
    return broadcast_if_small(df, F.length(text) * 4 + _TERM_BYTES, rows, size)


def _choose(corpus: Corpus, options: Options, scratch: Scratch) -> DataFrame:
    """The hits that every query keeps, as ``selection`` has them."""
    k, prefix, dedup = options.k, options.prefix, options.dedup
    scored = corpus.scored_by_blocks()
    if scored is not None:
        return blocks.choose(scored, scratch.stored(selection.new_choice(corpus.term_rows)), k, prefix, dedup, scratch)
    value = merit(F.col("score"))
    held = corpus.best_hits(*selection.prefix_lengths(k, prefix))

    def stretch(choice: DataFrame, condition: Column, used_up: Column) -> tuple[DataFrame, bool]:
        choice, short = selection.choose_held(choice, held.where(condition), k, prefix, dedup, scratch)
        if not short:
            return choice, short
        further = scratch.stored(selection.beyond_held(choice, held, used_up, k))
        return selection.choose(further, lambda queries: corpus.hits(queries).where(condition), k, dedup, scratch, prefix)

    choice = selection.new_choice(corpus.term_rows)
    if not options.pad_zero:
        return stretch(choice, F.lit(True), F.lit(True))[0]
    choice, short = stretch(choice, value > 0, value > 0)
    if short:
        choice, short = padding.choose_zeros(corpus, held, choice, k, prefix, dedup, scratch)
    if short:
        choice, _ = stretch(selection.next_stretch(choice, k), value < 0, F.lit(True))
    return choice


def rank_documents(
    queries: DataFrame, articles: DataFrame | ArticleIndex, options: Options = Options()
) -> DataFrame:
    """The best hits of every query: (query_id, query, rank, id, title, score).

    ``queries`` has columns (query_id, query), ``articles`` those of ``schema.ARTICLE``; an index of the articles may stand
    in their place. Articles are scored with DPH on title and first five paragraphs. Hits rank by score, equal scores by
    id; NaN ranks last. A query without terms has no hits. Tables in between are removed, the hits are a checkpoint.
    """
    with Scratch(queries.sparkSession) as scratch:
        corpus = Corpus(queries, articles, options, scratch)
        hits = selection.chosen_hits(_choose(corpus, options, scratch))
        return checkpointed(hits.join(queries.select("query_id", "query"), "query_id").select(
            "query_id", "query", "rank", "id", "title", "score"
        ))
