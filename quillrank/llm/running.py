"""Prefix sums within groups over a sort by ranges: no task holds a group, however many rows one has."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrank.storage import Scratch, broadcast_if_small

_OFFSETS = 200_000  # rows of (partition, group), of up to this many bytes, that are broadcast
_OFFSET_BYTES = 32 << 20


def _within_partition(names: list[str], group: str, values: list[str]):
    """A task that adds, per value, the sum over the rows of the group that it has seen before."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, totals = TaskContext.get().partitionId(), None, [0] * len(values)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups = batch.column(names.index(group)).to_numpy().astype(np.int64)
            starts = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1))
            runs = np.diff(starts, append=n)
            sums = []
            for i, name in enumerate(values):
                own = batch.column(names.index(name)).to_numpy().astype(np.int64)
                ends = np.cumsum(own)
                here = ends - own - np.repeat((ends - own)[starts], runs)
                if groups[0] == last:
                    here[: runs[0]] += totals[i]
                totals[i] = int(here[-1] + own[-1])
                sums.append(pa.array(here))
            last = groups[-1]
            parts = pa.array(np.full(n, part, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, parts, *sums], names=[*names, "part", *[f"here_{v}" for v in values]]
            )

    return summed


def running_totals(rows: DataFrame, group: str, order: list[str], values: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``before_<value>`` per value: its sum over the rows of the ``group`` that come earlier in ``order``.

    ``group`` is a column of numbers without nulls, ``values`` are ones of whole numbers. Rows are sorted by ranges of (group, order);
    a task sums up within its partition, and partitions then get the totals of those before, one row per
    partition and group. The sort is stored first, so that both see the same partitions. Rows that are equal in
    ``order`` stand in any order. No rows give no rows.
    """
    names = rows.columns
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    fields += ["part int", *[f"here_{v} bigint" for v in values]]
    placed = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = scratch.stored(placed.mapInArrow(_within_partition(names, group, values), ", ".join(fields)))
    totals = placed.groupBy("part", group).agg(*[F.sum(v).alias(f"total_{v}") for v in values])
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.stored(totals.select(
        "part", group, *[F.coalesce(F.sum(f"total_{v}").over(earlier), F.lit(0)).alias(f"offset_{v}") for v in values]
    ))
    offsets = broadcast_if_small(offsets, F.lit(32), _OFFSETS, _OFFSET_BYTES)
    before = [(F.col(f"here_{v}") + F.col(f"offset_{v}")).alias(f"before_{v}") for v in values]
    return placed.join(offsets, ["part", group]).select(*names, *before)
