"""Reproducible shuffle into shards: a keyed Feistel permutation of row numbers, in DataFrame functions only.

Row numbers 0..n-1 are pairs (left, right) of a grid of about sqrt(n) by sqrt(n). Each round adds a keyed
hash of one half to the other, modulo that half's size, which can be undone, so the rounds permute the
grid. Grid cells beyond n-1 are walked over: the permutation is applied until the number is below n
again, which keeps it a permutation of 0..n-1. Shard and slot of a row follow from its permuted number
alone, without a sort of the shuffled rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.storage import Scratch

ROUNDS = 6
_MOST_WALKED = 64  # a walk of 64 steps needs a grid of over 4,096 rows and has a chance under 64^-64
_SLOT_BITS = 33  # monotonically_increasing_id puts the partition above these bits


def _side(n: int) -> int:
    side = max(1, int(n**0.5))
    while side * side < n:
        side += 1
    return side


def permuted(number: Column, n: int, seed: int) -> Column:
    """Where row ``number`` of ``n`` goes: a permutation of 0..n-1 that ``seed`` decides."""
    width = _side(n)
    height = -(-n // width)

    def once(value: Column) -> Column:
        left, right = value % F.lit(width), F.floor(value / F.lit(width)).cast("bigint")
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(i)), F.lit(width)), F.lit(width))
            else:
                right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(i)), F.lit(height)), F.lit(height))
        return right * F.lit(width) + left

    beyond = width * height - n
    first = once(number)
    if not beyond:
        return first
    steps = F.sequence(F.lit(1), F.lit(min(beyond, _MOST_WALKED)))
    walked = F.aggregate(steps, first, lambda at, _: F.when(at < n, at).otherwise(once(at)))
    return F.when(first < n, first).when(walked < n, walked).otherwise(
        F.raise_error(F.lit("cycle walk too long: take another seed"))
    )


def numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """``rows`` with ``number`` from 0 in ``order``, and their count; one sort by ranges, no window over rows."""
    placed = scratch.stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("place", _SLOT_BITS))
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))
    # One row per partition of the sort, however many rows those have.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    in_part = F.col("place").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    number = (F.col("base") + in_part).alias("number")
    return placed.join(F.broadcast(bases), "part").select(*rows.columns, number), placed.count()


def shard(documents: DataFrame, scratch: Scratch, shards: int, seed: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, number, permuted, shard, slot) for every row of ``documents`` (doc_id, text).

    Law ``rows``: row counts of shards differ by one at most; slots of a shard run from 0 without gaps.
    ``size`` is the UTF-8 bytes of the text plus 16; a null text has none, and the checksum of the empty
    text. Rows are numbered by doc_id, then size and checksum, so the same rows always get the same places;
    nulls come first and fully equal rows differ in place only. Equal texts are rows like others: no
    group is kept together, so none can overfill a shard. Other columns are not read; no rows give no rows.
    Only (doc_id, size, checksum) are sorted, never texts.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed, n = numbered(rows, ["doc_id", "size", "text_crc32"], scratch)
    shuffled = placed.withColumn("permuted", permuted(F.col("number"), max(n, 1), seed))
    return shuffled.select(
        "*",
        (F.col("permuted") % shards).cast("int").alias("shard"),
        F.floor(F.col("permuted") / F.lit(shards)).cast("bigint").alias("slot"),
    )
