"""Adding up the scores of many queries for a block of articles at a time, in numpy; runs in Python workers.

A posting is an article, a term and the score of the term there; the index has for each term the queries that have it. Term scores are
multiples of 2^-40, so sums are exact in any order, here as in the JVM.
"""

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors get these functions with the plan, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = 2_000_000  # scores of a block, articles times queries
ADDED = 150_000  # products that are added at a time, few enough for a core's cache


@dataclass(frozen=True)
class QueryIndex:
    """Of term ``t`` the queries are ``queries[starts[t]:starts[t + 1]]``, ``times`` how often these have it. ``ids`` and ``sizes`` are by query."""

    starts: np.ndarray
    queries: np.ndarray
    times: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(terms: np.ndarray, queries: np.ndarray, times: np.ndarray, n_terms: int, ids: np.ndarray, sizes: np.ndarray) -> "QueryIndex":
        """From one element per term and query, in any order."""
        order = np.argsort(terms, kind="stable")
        starts = np.zeros(n_terms + 1, np.int64)
        np.cumsum(np.bincount(terms, minlength=n_terms), out=starts[1:])
        return QueryIndex(starts, queries[order].astype(np.int32), times[order].astype(np.float64), ids, sizes.astype(np.float64))

    def only(self, wanted: np.ndarray) -> "QueryIndex":
        """The index of the queries where ``wanted`` is true; terms keep their numbers."""
        kept = wanted[self.queries]
        before = np.concatenate([[0], np.cumsum(kept)])
        number = np.cumsum(wanted) - 1
        return QueryIndex(
            before[self.starts], number[self.queries[kept]].astype(np.int32), self.times[kept], self.ids[wanted], self.sizes[wanted]
        )


def added(index: QueryIndex, rows: np.ndarray, terms: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """Scores by article and query, 0 where they have no term in common. ``rows`` are the numbers of the articles, below ``count``."""
    width = len(index.ids)
    lengths = index.starts[terms + 1] - index.starts[terms]
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(index.starts[terms] - (ends - lengths), lengths)
    cells = np.repeat(rows * width, lengths) + index.queries[at]
    with np.errstate(invalid="ignore"):
        totals = np.bincount(cells, weights=np.repeat(scores, lengths) * index.times[at], minlength=count * width)
        return totals.reshape(count, width) / index.sizes + 0.0


def blocks(index: QueryIndex, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, scores by article and query) from batches of (slot, number, term_score) whose rows of an article stand together."""
    height = max(1, CELLS // max(1, len(index.ids)))

    def summed(slots: np.ndarray, terms: np.ndarray, scores: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not len(slots):
            return
        heads = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        ends = np.append(heads[1:], len(slots))
        work = np.cumsum(np.add.reduceat(index.starts[terms + 1] - index.starts[terms], heads))
        for top in range(0, len(heads), height):
            bottom = min(top + height, len(heads))
            parts, first = [], top
            while first < bottom:
                done = work[first - 1] if first else 0
                last = min(max(first + 1, int(np.searchsorted(work, done + ADDED, side="right"))), bottom)
                part = slice(heads[first], ends[last - 1])
                rows = np.repeat(np.arange(last - first), ends[first:last] - heads[first:last])
                parts.append(added(index, rows, terms[part], scores[part], last - first))
                first = last
            yield slots[heads[top:bottom]], np.concatenate(parts)

    left: list[tuple[np.ndarray, ...]] = []
    waiting = 0
    for batch in batches:
        left.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
        waiting += len(left[-1][0])
        if waiting < 50_000:
            continue
        slots, terms, scores = (np.concatenate(x) for x in zip(*left))
        changes = np.flatnonzero(slots[1:] != slots[:-1])
        whole = changes[-1] + 1 if len(changes) else 0
        yield from summed(slots[:whole], terms[:whole], scores[:whole])
        left, waiting = [(slots[whole:], terms[whole:], scores[whole:])], 0
    if left:
        yield from summed(*(np.concatenate(x) for x in zip(*left)))


def _emitted(index: QueryIndex, slots: np.ndarray, scores: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> pa.RecordBatch:
    found = scores[rows, columns]
    return pa.RecordBatch.from_arrays([pa.array(index.ids[columns]), pa.array(slots[rows]), pa.array(found)], ["query_id", "slot", "score"])


def best_of_tasks(index: QueryIndex, count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: of each task the best ``count`` scores over 0 of every query, as (query_id, best)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, len(index.ids)))
        for _, scores in blocks(index, batches):
            best = np.concatenate([best, np.where(scores > 0, scores, 0.0)])  # NaN is not over 0
            if len(best) > count:
                best = np.ascontiguousarray(np.partition(best, len(best) - count, axis=0)[-count:])
        for column in range(0, len(index.ids) if len(best) else 0, 1000):
            part = best[:, column:column + 1000].T
            some = part > 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some.sum(1))]), pa.int32()), pa.array(part[some]))
            yield pa.RecordBatch.from_arrays([pa.array(index.ids[column:column + 1000]), lists], ["query_id", "best"])

    return run


def hits_from(index: QueryIndex, floors: np.ndarray, count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: the hits over 0 that score their query's floor or more, as (query_id, slot, score).

    Of hits at the floor itself at most ``count`` of a block, those with the least slots.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slots, scores in blocks(index, batches):
            chosen = (scores >= floors) & (scores > 0)
            equal = chosen & (scores == floors)
            many = np.flatnonzero(equal.sum(0) > count)
            if len(many):
                in_order = np.argsort(slots, kind="stable")
                later = np.cumsum(equal[in_order][:, many], axis=0) > count
                drop = np.zeros((len(slots), len(many)), bool)
                drop[in_order] = later
                chosen[:, many] &= ~(drop & equal[:, many])
            yield _emitted(index, slots, scores, *np.nonzero(chosen))

    return run


def hits_where(index: QueryIndex, condition: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: (query_id, slot, score) of all articles whose score is ``over``, ``zero`` or ``under``; NaN is under 0."""
    tests = {"over": lambda x: x > 0, "zero": lambda x: x == 0, "under": lambda x: ~(x >= 0)}
    test = tests[condition]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slots, scores in blocks(index, batches):
            yield _emitted(index, slots, scores, *np.nonzero(test(scores)))

    return run
