"""Hard negatives against all exact scores."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from quillrank.llm import hardnegatives

FIELDS = "vec_id bigint, embedding array<double>, label int"
ANCHORS = "vec_id % 100 = 0"


def by_all_scores(rows, positives=5, negatives=10):
    """Expected rows for (vec_id, vector, label); vectors as lists, anchors are ids divisible by 100."""
    usable = [
        (vec_id, [math.floor(256 * Fraction(x)) for x in vector], label)
        for vec_id, vector, label in rows
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    found = []
    for k, (anchor, own, label) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(own, other, strict=True)), vec_id is None, vec_id or 0, vec_id, other_label, i)
            for i, (vec_id, other, other_label) in enumerate(usable) if len(other) == len(own)
        ]
        scored.sort(key=lambda s: s[:3])
        for near in [s for s in scored if s[4] == label and s[5] != k][:positives]:
            fit = [s for s in scored if s[4] != label and 30 * -near[0] <= 100 * -s[0] <= 90 * -near[0]]
            found += [(anchor, near[3], n, s[3], -near[0], -s[0]) for n, s in enumerate(fit[:negatives], 1)]
    return sorted(map(repr, found))


def found_by(spark, scratch, rows, **options):
    found = hardnegatives.hard_negatives(spark.createDataFrame(rows, FIELDS), ANCHORS, scratch, **options)
    return sorted(repr(tuple(r)) for r in found.collect())


@pytest.mark.parametrize(("anchors", "candidates"), [(256, 4096), (2, 37)])
def test_clusters(spark, scratch, monkeypatch, anchors, candidates):
    monkeypatch.setattr(hardnegatives, "ANCHORS", anchors)
    monkeypatch.setattr(hardnegatives, "CANDIDATES", candidates)
    rng = np.random.default_rng(13)
    centers = rng.standard_normal((6, 12))
    rows = [(i, (centers[i % 6] + rng.standard_normal(12)).tolist(), int(rng.integers(4))) for i in range(900)]
    rows += [(i, rows[0][1], i % 2) for i in range(2000, 2150)]  # a common vector: ties by vec_id
    wanted = by_all_scores(rows)
    assert len(wanted) > 300
    assert found_by(spark, scratch, rows) == wanted
    assert found_by(spark, scratch, rows, positives=2, negatives=3) == by_all_scores(rows, 2, 3)


def test_odd_rows(spark, scratch):
    v, nan, inf = [1.0, 2.0, -0.5], float("nan"), float("inf")
    near = [0.5, 1.0, 0.1]
    rows = [
        (0, v, 0), (0, v, 0), (1, v, 0), (2, near, 1), (2, near, 1), (None, near, 1), (None, v, 0), (3, near, None), (4, None, 1),
        (5, [1.0, None, 2.0], 1), (6, [nan, 1.0, 1.0], 1), (7, [inf, 1.0, 1.0], 1), (8, [1.0, 1.0], 1), (100, [1.0, 1.0], 2), (101, [1.0, 1.1], 2),
        (200, [], 3), (201, [], 3), (202, [], 4), (300, [0.0, 0.0, 0.0], 5), (301, [1e-9, -1e-9, 0.3], 5),
    ]
    assert found_by(spark, scratch, rows) == by_all_scores(rows)
    clash = spark.createDataFrame([(*r, "own", "own") for r in rows], f"{FIELDS}, row string, score string")
    found = hardnegatives.hard_negatives(clash, ANCHORS, scratch)
    assert sorted(repr(tuple(r)) for r in found.collect()) == by_all_scores(rows)
    assert hardnegatives.hard_negatives(spark.createDataFrame([], FIELDS), ANCHORS, scratch).isEmpty()
    assert hardnegatives.hard_negatives(spark.createDataFrame(rows[:3], FIELDS), ANCHORS, scratch).isEmpty()


def test_wide_components(spark, scratch):
    rng = random.Random(5)
    rows = [(i * 10, [rng.uniform(-1, 1) * 10.0 ** rng.randint(0, 5) for _ in range(5)], i % 3) for i in range(60)]
    assert found_by(spark, scratch, rows) == by_all_scores(rows)
    tall = [(0, [1e30, 0.0], 0), (1, [2.0, 1.0], 0), (2, [-1e300, 1.0], 1)]
    with pytest.raises(Exception, match="64 bits"):
        found_by(spark, scratch, tall)


@pytest.mark.parametrize("size", [3, 200, 10**6, 10**12, 10**25])
def test_packed_products(size):
    rng = random.Random(size)
    a, b = ([[rng.randint(-size, size // 3) for _ in range(7)] for _ in range(n)] for n in (4, 31))
    kind = np.int64 if size < 10**15 else object
    found = [list(map(int, own)) for own in hardnegatives.scores(np.array(a, dtype=kind), np.array(b, dtype=kind))]
    assert found == [[sum(x * y for x, y in zip(u, v, strict=True)) for v in b] for u in a]
