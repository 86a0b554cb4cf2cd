"""Greedy choice of the best hits per query, dropping near-duplicate titles.

Walking down the ranked hits of a query, a hit is kept unless its title is near that of a hit
already kept, until ``k`` are kept. The walk is sequential, but it goes by short prefixes: what a
prefix keeps is enough to drop, in parallel and before any shuffle, every later hit near it. The
first hit left is then always kept, so a query needs at most ``k`` prefixes whatever share of its
hits are near duplicates, and no task ever holds more than one prefix of a query.

Articles are scored once for the best hits of every query, some prefixes of them, which are held in a stored table. Only
queries that use up what is held have articles scored for them again.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.functions.relevance import merit
from quillrank.functions.titles import is_near_duplicate, title_profile
from quillrank.operators.bags import CANDIDATE
from quillrank.storage import Scratch, broadcast_if_small

# Hits in one prefix. More means fewer rounds for queries with many near duplicates.
PREFIX = 100

# Prefixes of a query that are held once its hits are scored.
HELD_PREFIXES = 4

# Spark plans a cut before the shuffle for window ranks up to its own limit of 1000.
LONGEST_PREFIX = 1000

_CUTS = 32

# A table of per-query state up to these sizes is broadcast.
STATE_ROWS = 1_000_000
STATE_BYTES = 64 << 20

_KEPT = "array<struct<id: string, title: string, score: double, profile: array<int>>>"

# Hits are ranked by score, then by id. The rest of the candidate settles what order is left.
_DEMERIT = "demerit"
_PLACE = [_DEMERIT, *CANDIDATE]


def new_choice(term_rows: DataFrame) -> DataFrame:
    """(query_id, kept, last, more): nothing kept yet, for each query that has a term."""
    return term_rows.select("query_id").distinct().select(
        "query_id",
        F.array().cast(_KEPT).alias("kept"),
        F.lit(True).alias("more"),
    )


def _near_a_kept(kept: Column, title: Column, profile: Column) -> Column:
    # Most near duplicates are plain copies: look for those before measuring any distance.
    copy = (title != "") & F.exists(kept, lambda hit: hit["title"] == title)
    return copy | F.exists(kept, lambda hit: is_near_duplicate(hit["title"], title, hit["profile"], profile))


def prefix_lengths(k: int, prefix: int) -> tuple[int, int]:
    """Hits in one prefix, and hits that are held per query, for ``k`` wanted ones."""
    first = min(max(prefix, k), LONGEST_PREFIX)
    return first, min(HELD_PREFIXES * first, LONGEST_PREFIX)


def _first_hits(hits: DataFrame, count: int) -> DataFrame:
    """The best ``count`` hits of each query, in two cuts.

    Spark cuts both per task before their shuffles. The first goes by query and a number that all rows of a
    task share, so that however many tasks there are, the last one of a query sorts ``_CUTS`` times ``count`` rows.
    """
    dealt = hits.withColumn("cut", F.pmod(F.spark_partition_id(), F.lit(_CUTS)))
    for keys in (["query_id", "cut"], ["query_id"]):
        order = Window.partitionBy(*keys).orderBy(*_PLACE)
        dealt = dealt.withColumn("position", F.row_number().over(order)).where(F.col("position") <= count)
    return dealt.drop("cut")


def _placed(hits: DataFrame) -> DataFrame:
    return hits.withColumn(_DEMERIT, -merit(F.col("score")))


def best_hits(hits: DataFrame, count: int) -> DataFrame:
    """The best ``count`` hits of each query with their ``position``, from 1, and the profile of their titles.

    ``hits`` may have a ``floor``: these are the ones that a query has at that score or above, others are left out. ``whole``
    tells whether these are all hits of the query.
    """
    if "floor" in hits.columns:
        hits = hits.where(F.col("floor").isNull() | (merit(F.col("score")) >= F.col("floor")))
    else:
        hits = hits.withColumn("floor", F.lit(None).cast("double"))
    best = _first_hits(_placed(hits), count).withColumn("profile", title_profile(F.col("title")))
    held = F.count("*").over(Window.partitionBy("query_id"))
    return best.withColumn("whole", F.col("floor").isNull() & (held < count)).drop("floor")


def _in_order(prefix: Column, k: int, dedup: bool) -> Column:
    """``prefix`` as hits to keep, as often as copies of it may be kept."""
    def copies_of(hit: Column) -> Column:
        # A copy with a title is a near duplicate of the first one, whether that was kept or not.
        useful = F.least(hit["copies"], F.lit(k)).cast("int")
        repeats = F.when(hit["title"] == "", useful).otherwise(1) if dedup else useful
        return F.array_repeat(F.struct(hit["id"], hit["title"], hit["score"], hit["profile"]), repeats)

    walked = F.flatten(F.transform(prefix, copies_of)).cast(_KEPT)
    return F.coalesce(walked, F.array().cast(_KEPT))


def _fold(kept: Column, prefix: Column, k: int, dedup: bool) -> Column:
    """``kept`` after walking down ``prefix``."""

    def step(so_far: Column, hit: Column) -> Column:
        wanted = F.size(so_far) < k
        if dedup:
            wanted = wanted & ~_near_a_kept(so_far, hit["title"], hit["profile"])
        return F.when(wanted, F.concat(so_far, F.array(hit))).otherwise(so_far)

    return F.aggregate(_in_order(prefix, k, dedup), kept, step)


def _still_wanted(choice: DataFrame, hits: DataFrame, dedup: bool) -> DataFrame:
    """``hits`` of the queries that want more, beyond where those stand and not near what they kept."""
    width = F.lit(64) + F.aggregate("kept", F.lit(0), lambda n, hit: n + F.length(hit["title"]) * 4 + 64)
    wanting = broadcast_if_small(choice.where("more").drop("more"), width, STATE_ROWS, STATE_BYTES)
    found = hits.join(wanting, "query_id").where(F.col("last").isNull() | (F.struct(*_PLACE) > F.col("last")))
    if dedup:
        found = found.where(~_near_a_kept(F.col("kept"), F.col("title"), F.col("profile")))
    return found.drop("kept", "last")


def _prefixes(hits: DataFrame) -> DataFrame:
    """(query_id, prefix): the ``hits`` of each query, in order."""
    # Edit distances take long for the few bytes they read, so partitions must not be merged by size.
    partitions = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hits.repartition(partitions, "query_id").groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct(*_PLACE, "copies", "score", "profile"))).alias("prefix")
    )


def _walked(choice: DataFrame, hits: DataFrame, k: int, dedup: bool, full: Column | None = None) -> DataFrame:
    """``choice`` after every query walked down its ``hits``, a prefix at most.

    ``full`` tells from ``prefix``, an array of hits or null, whether there may be more to walk.
    """
    prefixes = _prefixes(hits)
    kept = _fold(F.col("kept"), F.col("prefix"), k, dedup)
    end = F.get("prefix", F.size("prefix") - 1)
    more = F.lit(False) if full is None else F.coalesce(full, F.lit(False))
    walked = choice.drop("last", "more").join(prefixes, "query_id", "left")
    return walked.select("query_id", kept.alias("kept"), "prefix", end.alias("end")).select(
        "query_id",
        "kept",
        ((F.size("kept") < k) & more).alias("more"),
        F.struct(*[F.col("end")[name].alias(name) for name in _PLACE]).alias("last"),
    )


def walked(choice: DataFrame, hits: DataFrame, k: int, dedup: bool, fold: Callable[[Column, Column, int], Column] | None) -> DataFrame:
    """(query_id, kept): ``choice`` after every query walked down all its ``hits``. ``fold`` stands in for the fold in the JVM."""
    if fold is None:
        return _walked(choice, hits, k, dedup).select("query_id", "kept")
    prefixes = _prefixes(hits).select("query_id", _in_order(F.col("prefix"), k, dedup).alias("walked"))
    going = choice.select("query_id", "kept").join(prefixes, "query_id", "left")
    return going.select("query_id", fold(F.col("kept"), F.coalesce("walked", F.array().cast(_KEPT)), k).alias("kept"))


def _state(choice: DataFrame, k: int) -> tuple[bool, bool]:
    """Whether any query wants to go on, and whether any has fewer than ``k`` hits."""
    left = choice.agg(F.max("more").alias("more"), F.max(F.size("kept") < k).alias("short")).first()
    return bool(left["more"]), bool(left["short"])


def choose_held(
    choice: DataFrame, held: DataFrame, k: int, prefix: int, dedup: bool, scratch: Scratch
) -> tuple[DataFrame, bool]:
    """Carry ``choice`` through the hits that are ``held``, a prefix of each query first, then the others.

    ``held`` is what ``best_hits`` gave, or the part of it in one stretch of the ranking. The second value tells whether any query
    still has fewer than ``k``.
    """
    going = "last" in choice.columns
    if not going:
        first, _ = prefix_lengths(k, prefix)
        walked = _walked(choice, held.where(F.col("position") <= first), k, dedup, F.size("prefix") == first)
        choice = scratch.stored(walked)
        going, short = _state(choice, k)
    if going:
        choice = scratch.stored(_walked(choice, _still_wanted(choice, held, dedup), k, dedup))
        _, short = _state(choice, k)
    return choice, short


def beyond_held(choice: DataFrame, held: DataFrame, used_up: Column, k: int) -> DataFrame:
    """``choice`` with what is wanted beyond the hits held: by queries that have more hits, where the last one held is ``used_up``."""
    end = F.struct(*_PLACE)
    ends = held.where("not whole").groupBy("query_id").agg(F.max(end).alias("last"), F.max_by("score", end).alias("score"))
    ends = ends.where(used_up).select("query_id", "last")
    return choice.drop("last", "more").join(ends, "query_id", "left").withColumn(
        "more", (F.size("kept") < k) & F.col("last").isNotNull()
    )


def choose(
    choice: DataFrame,
    hits_of: Callable[[DataFrame], DataFrame],
    k: int,
    dedup: bool,
    scratch: Scratch,
    prefix: int = PREFIX,
) -> tuple[DataFrame, bool]:
    """Carry ``choice``, a stored table, through all hits of one stretch of the ranking, by prefixes scored when they are wanted.

    ``hits_of(queries)`` gives the hits of the stretch for those queries. The second value tells whether any query still has
    fewer than ``k``.
    """
    first, _ = prefix_lengths(k, prefix)
    more, short = _state(choice, k)
    while more:
        hits = _placed(hits_of(choice.where("more").select("query_id"))).withColumn("profile", title_profile(F.col("title")))
        best = _first_hits(_still_wanted(choice, hits, dedup), first)
        choice = scratch.stored(_walked(choice, best, k, dedup, F.size("prefix") == first))
        more, short = _state(choice, k)
    return choice, short


def next_stretch(choice: DataFrame, k: int) -> DataFrame:
    """``choice`` at the start of a new stretch: every query short of ``k`` wants more."""
    nowhere = ", ".join(f"{name}: {kind}" for name, kind in [
        (_DEMERIT, "double"), ("id", "string"), ("title", "string"), ("length", "int"),
        ("fingerprint", "binary"),
    ])
    return choice.select(
        "query_id", "kept", (F.size("kept") < k).alias("more"),
        F.lit(None).cast(f"struct<{nowhere}>").alias("last"),
    )


def chosen_hits(choice: DataFrame) -> DataFrame:
    """(query_id, rank, id, title, score)"""
    return choice.select("query_id", F.posexplode("kept").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.id", "hit.title", "hit.score"
    )
