"""Consecutive row numbers without a global sort in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrank.storage import checkpointed

_SLOT_BITS = 33  # monotonically_increasing_id puts the partition above these bits


def numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``df`` with ``number``, 1 for the first row in ``order``, and the count of rows.

    Rows are sorted by range into partitions; the number of a row is its place in its partition
    plus the rows of the partitions before. The sort is checkpointed first, so that places and
    counts are of the same partitions.
    """
    placed = checkpointed(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("slot", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("slot", _SLOT_BITS))
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))
    # One row per partition of the sort, however many rows those have.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    in_part = F.col("slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    with_offset = placed.join(F.broadcast(offsets), "part")
    return (
        with_offset.withColumn("number", F.col("offset") + in_part + 1).drop("slot", "part", "offset"),
        placed.count(),
    )
