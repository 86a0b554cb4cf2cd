"""The greedy walk down ranked titles, in Python workers: one pass over a title measures it against all kept ones.

Edit distances are those of ``titles.title_distance``. Myers' bit vectors (G. Myers, JACM 46, 1999) stand side by side in one long number,
a spare bit between two titles takes their carries.
"""

import sys
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get these functions with the plan, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KNOWN_PAIRS = 50_000  # what is remembered of pairs of titles


def distances(titles: list[str], text: str) -> list[int]:
    """The edit distance of each of ``titles`` from ``text``."""
    places: dict[str, int] = {}
    low = mask = at = 0
    spans = []
    for title in titles:
        bit = 1 << at
        low |= bit
        for c in title:
            places[c] = places.get(c, 0) | bit
            bit <<= 1
        own = (1 << len(title)) - 1
        mask |= own << at
        spans.append((at, own))
        at += len(title) + 1
    more, less = mask, 0  # rows where the distance grows by one, and where it falls
    of = places.get
    for c in text:
        equal = of(c, 0)
        vertical = equal | less
        across = (((equal & more) + more) ^ more) | equal
        up = (((less | (mask ^ ((across | more) & mask))) << 1) | low) & mask
        more, less = (((more & across) << 1) & mask) | (mask ^ ((vertical | up) & mask)), up & vertical
    return [len(text) + (more >> at & own).bit_count() - (less >> at & own).bit_count() for at, own in spans]


def _most_edits(left: str, right: str) -> int:
    return (max(len(left), len(right)) - 1) // 2


class Titles:
    """Tells near duplicates, as ``titles.is_near_duplicate`` does; remembers letters of titles and pairs."""

    def __init__(self) -> None:
        self._letters: dict[str, Counter] = {}
        self._near: dict[tuple[str, str], bool] = {}

    def _apart(self, left: str, right: str) -> int:
        """No more than the edit distance: letters that one title has more often."""
        one, other = (self._letters[x] if x in self._letters else self._letters.setdefault(x, Counter(x)) for x in (left, right))
        return max((one - other).total(), (other - one).total())

    def near_one_of(self, kept: list[str], title: str) -> bool:
        if title and title in kept:
            return True
        asked = []
        for other in kept:
            most = _most_edits(other, title)
            if other == title or abs(len(other) - len(title)) > most:
                continue  # two empty titles have no distance
            known = self._near.get((other, title))
            if known:
                return True
            if known is None:
                if self._apart(other, title) > most:
                    self._near[other, title] = False
                else:
                    asked.append(other)
        near = False
        for other, distance in zip(asked, distances(asked, title) if asked else []):
            self._near[other, title] = distance <= _most_edits(other, title)
            near = near or self._near[other, title]
        if len(self._near) > KNOWN_PAIRS:
            self._near.clear()
            self._letters.clear()
        return near

    def walk(self, kept: list[str], titles: list[str], k: int) -> list[int]:
        """The places of those of ``titles`` that are kept besides ``kept``, until ``k`` are."""
        kept, chosen = list(kept), []
        for place, title in enumerate(titles):
            if len(kept) >= k:
                break
            if not self.near_one_of(kept, title):
                kept.append(title)
                chosen.append(place)
        return chosen


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def kept_places(kept: pa.Array, titles: pa.Array, k: pa.Array) -> pa.Array:
    """For each row the places of its ``titles`` that are kept besides ``kept``, until ``k`` are."""
    known = Titles()
    rows = zip(kept.to_pylist(), titles.to_pylist(), k.to_pylist())
    return pa.array([known.walk(*row) for row in rows], pa.list_(pa.int32()))
