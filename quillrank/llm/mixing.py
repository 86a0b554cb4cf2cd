"""Mixing sources to target weights: which documents, and how much of them, a mixture takes of each source.

Every source gets a budget of words. Its documents stand in the order of a random key that follows from their id, and
prefix sums of their sizes tell which ones a budget reaches: those before the cut are taken whole, the one at the cut in
part. A budget larger than its source takes whole epochs first and cuts in the next one. Only (key, id, size) rows are
sorted, by ranges, so a source of any size is spread over all tasks.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm.running import running_totals
from quillrank.llm.sharding import numbered
from quillrank.storage import Scratch, broadcast_if_small

WORD = r"[^\x20\x09-\x0D]+"
_SOURCES, _SOURCE_BYTES = 200_000, 64 << 20  # tables of sources up to these sizes are broadcast
_WHOLE = "decimal(38,0)"


def _random_key(seed: int) -> Column:
    """60 bits of md5 over seed and id; a null id counts as empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def budgets(sizes: DataFrame, scratch: Scratch, weights: Sequence[int], percent: int, repeats: int) -> DataFrame:
    """(source, number, source_size, target, budget) for every row of ``sizes`` (source, source_size).

    Sources in the order of their names' code points, null last, get the ``weights`` in turn. They share
    ``percent`` of all sizes by weight; no target exceeds ``repeats`` times its source's size, and what is above goes to the
    others by weight, until none is above. So there is one level, target over weight, for all sources below their caps.
    A source is at its cap if the total suffices to bring all to the level where it gets there: with sources sorted by
    cap over weight, that follows from prefix sums of caps and weights. Everything is in whole numbers but the last division.
    ``budget`` is the target rounded to whole words, one half upwards.
    """
    if percent > 100 * repeats:
        raise ValueError("the share cannot exceed what all sources may give")
    given = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    named, _ = numbered(sizes.withColumn("unnamed", F.col("source").isNull()), ["unnamed", "source"], scratch)
    named = named.drop("unnamed").withColumn("weight", given.cast("bigint"))
    # Caps are repeats x size; sizes over weights sort as caps over weights do. All weights times each size is exact.
    common = 1
    for weight in set(weights):
        common *= weight
    level = (F.col("source_size").cast(_WHOLE) * F.call_function("div", F.lit(common), F.col("weight"))).cast(_WHOLE)
    named = scratch.stored(named.withColumn("level", level).withColumn("one", F.lit(0)))
    below = running_totals(named, "one", ["level", "number"], ["source_size", "weight"], scratch)
    whole = lambda name: F.col(name).cast(_WHOLE)
    sums = named.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("all_sizes"), F.coalesce(F.sum("weight"), F.lit(0)).alias("all_weights")
    )
    below = below.withColumn("all_sizes", sums.select("all_sizes").scalar()).withColumn("all_weights", sums.select("all_weights").scalar())
    # What all sources get together at the level where this one is at its cap, times 100 x its weight.
    at_cap = (
        whole("before_source_size") * F.col("weight")
        + whole("source_size") * (whole("all_weights") - F.col("before_weight"))
    ) * (100 * repeats)
    placed = scratch.stored(below.withColumn("capped", at_cap <= whole("all_sizes") * F.col("weight") * percent))
    open_sums = placed.agg(
        F.sum(F.when(F.col("capped"), F.col("source_size")).otherwise(0)).alias("capped_sizes"),
        F.sum(F.when(~F.col("capped"), F.col("weight")).otherwise(0)).alias("open_weights"),
    )
    capped_sizes, open_weights = (F.coalesce(open_sums.select(n).scalar(), F.lit(0)) for n in ("capped_sizes", "open_weights"))
    # Below the cap the target is parts / hundredths.
    parts = F.col("weight") * (whole("all_sizes") * percent - capped_sizes.cast(_WHOLE) * (100 * repeats))
    hundredths = open_weights.cast(_WHOLE) * 100
    cap = F.col("source_size") * repeats
    halves = F.call_function("div", (parts * 2 + hundredths).cast(_WHOLE), F.nullif(hundredths * 2, F.lit(0)).cast(_WHOLE))
    return placed.select(
        "source", "number", "source_size",
        F.when(F.col("capped"), cap.cast("double"))
        .otherwise(parts.cast("double") / F.nullif(hundredths, F.lit(0)).cast("double")).alias("target"),
        F.when(F.col("capped"), cap).otherwise(halves.cast("bigint")).alias("budget"),
    )


def mix(
    documents: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] = (5, 2, 1),
    percent: int = 150,
    repeats: int = 2,
    seed: int = 11,
) -> DataFrame:
    """(doc_id, source, key, text_hash, size, source_size, target, taken) for every row of ``documents`` (doc_id, text, source).

    ``size`` is the number of words of the text, 0 for null; ``taken`` the words that the mixture takes of the
    row, repeats counted: ``taken div size`` whole texts and the first ``taken mod size`` words of one more. For targets
    see ``budgets``. What a source's rows give is its target rounded to whole words, exactly; no row gives more than
    ``repeats`` times its size. A null source is a source of its own, a null id is ordered as an empty one. Rows are ordered by a key that id and
    seed decide, then by id, size and a hash of the text; rows equal in all of these are interchangeable, and one of them may be
    cut. Empty texts are taken 0 times. Other columns are not read; no rows give no rows. The result reads from ``scratch``.
    """
    rows = scratch.stored(documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", _random_key(seed).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), _words(F.col("text")).alias("size"),
    ))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = scratch.stored(budgets(sizes, scratch, weights, percent, repeats))
    few = broadcast_if_small(
        shares, F.coalesce(F.octet_length("source"), F.lit(0)) + 64, _SOURCES, _SOURCE_BYTES
    )
    # Beyond the bound a source may fill a shuffle partition; adaptive execution splits those.
    held = rows.join(few.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    summed = running_totals(held, "number", ["key", "doc_id", "size", "text_hash"], ["size"], scratch)
    epochs = F.call_function("div", F.col("budget"), F.nullif(F.col("source_size"), F.lit(0)))
    rest = F.col("budget") - epochs * F.col("source_size")
    cut = F.greatest(F.least(rest - F.col("before_size"), F.col("size")), F.lit(0))
    taken = F.coalesce(epochs * F.col("size") + cut, F.lit(0)).cast("bigint")
    return summed.select("doc_id", "source", "key", "text_hash", "size", "source_size", "target", taken.alias("taken"))


def mixture(documents: DataFrame, mixed: DataFrame, seed: int = 11) -> DataFrame:
    """The texts of a mixture: a row of ``documents``, all its columns as they are but the text, for each time it is taken.

    ``mixed`` is what ``mix`` gave for the same documents and seed. A text taken in part is its first words, joined by one
    space; others stay as they are. Of rows that are equal in id, source and text, the first stands for all, as often as these are taken
    together. Texts without words are never taken.
    """
    same = ["doc_id", "source", "key", "text_hash"]
    wanted = mixed.where("taken > 0").groupBy(*same).agg(
        F.first("size").alias("size"), F.sum("taken").alias("taken"), F.count("*").alias("copies")
    ).select(*[F.col(name).alias(f"mix {name}") for name in [*same, "size", "taken"]])
    found = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")
    found = found.withColumn("key", _random_key(seed)).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    # One row for equal ones: the cut per task comes before the shuffle.
    first = Window.partitionBy(*same).orderBy(F.lit(0))
    found = found.withColumn("nth", F.row_number().over(first)).where("nth = 1")
    matched = [F.col(name).eqNullSafe(F.col(f"mix {name}")) for name in same]
    condition = matched[0] & matched[1] & matched[2] & matched[3]
    times = F.ceil(F.col("mix taken") / F.col("mix size")).cast("bigint")
    chosen = found.join(wanted, condition).select(
        "row", "text", F.col("mix size").alias("size"), F.col("mix taken").alias("taken"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("time"),
    )
    size, taken = F.col("size"), F.col("taken")
    part = F.when(F.col("time") * size <= taken, F.col("text")).otherwise(
        F.concat_ws(" ", F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, (taken % size).cast("int")))
    )
    return chosen.select(part.alias("part"), "row").select(
        *[F.col("part").alias("text") if name == "text" else F.col("row")[name].alias(name) for name in documents.columns]
    )
