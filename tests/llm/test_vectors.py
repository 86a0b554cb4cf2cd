"""Links of vectors against all pairs."""

import math

import numpy as np
import pytest
from llm_rows import read_rows

from quillrank.llm import pivots
from quillrank.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


def by_all_pairs(rows, cosine=0.98):
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding, label) rows, in their order."""
    usable = []
    for _, vector, label in rows:
        ok = vector is not None and label is not None and len(vector) and all(v is not None and math.isfinite(v) for v in vector)
        usable.append(bool(ok) and any(vector))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    degree = [0] * len(rows)
    for i, (_, a, a_label) in enumerate(rows):
        for j, (_, b, b_label) in enumerate(rows[:i]):
            if usable[i] and usable[j] and a_label == b_label and len(a) == len(b):
                x, y = np.array(a, float) / max(map(abs, a)), np.array(b, float) / max(map(abs, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine - 1e-12:
                    degree[i] += 1
                    degree[j] += 1
                    parent[find(i)] = find(j)
    found = []
    for i, (vec_id, _, _) in enumerate(rows):
        members = [r[0] for k, r in enumerate(rows) if find(k) == find(i) and r[0] is not None]
        least = min(members, default=None)
        found.append((vec_id, degree[i], least, vec_id == least))
    return sorted(map(repr, found))


FIELDS = "vec_id bigint, embedding array<float>, label int"


def test_query_equals_all_pairs(spark):
    rows = read_rows(SF, "embeddings", ["vec_id", "embedding", "label"])
    found = LLM_QUERIES["op4_pivot_links"](spark, SF).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(repr(tuple(r)) for r in found) == by_all_pairs(rows)


@pytest.mark.parametrize("block", [1024, 8])
def test_groups_around_a_vector(spark, scratch, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rng = np.random.default_rng(7)
    rows = []
    for label in (0, 1):
        center = rng.standard_normal(32)
        for _ in range(70):
            rows.append((len(rows), (center + rng.normal(0, 0.14, 32)).astype(np.float32).tolist(), label))
        for _ in range(30):
            rows.append((len(rows), rng.standard_normal(32).astype(np.float32).tolist(), label))
    rows += [(i, rows[0][1], 0) for i in range(500, 520)] + [(600, (np.array(rows[1][1]) * 2).tolist(), 0)]
    found = pivots.nearest_links(spark.createDataFrame(rows, FIELDS), scratch).collect()
    assert sorted(repr(tuple(r)) for r in found) == by_all_pairs(rows)


def test_odd_vectors(spark, scratch):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (None, v, 0), (3, v, None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0, 0.0], 0),
        (7, [1.0, None, 3.0], 0), (8, [float("nan"), 2.0, 3.0], 0), (9, [float("inf"), 2.0, 3.0], 0), (10, [1.0, 2.0], 0),
        (11, [2.0, 4.0], 0), (None, [-1.0, 1.0, 0.0], 3), (12, [1e30, 2e30, 3e30], 0), (13, [1e-30, 2e-30, 3e-30], 0), (14, v, 1),
    ]
    clash = spark.createDataFrame([(*r, "own") for r in rows], f"{FIELDS}, key string")
    found = pivots.nearest_links(clash, scratch).collect()
    assert sorted(repr(tuple(r)) for r in found) == by_all_pairs(rows)


def test_no_vectors(spark, scratch):
    assert pivots.nearest_links(spark.createDataFrame([], FIELDS), scratch).isEmpty()


def test_recall_of_the_index():
    """Pairs at the threshold that share enough pivots, with few and with most pivots."""
    rng = np.random.default_rng(1)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(rng.standard_normal((2000, 64)))
    aside = rng.standard_normal((2000, 64))
    aside = unit(aside - (aside * a).sum(1, keepdims=True) * a)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * aside
    for count in (pivots.FEWEST_PIVOTS, 800, pivots.MOST_PIVOTS):
        points = unit(rng.standard_normal((count, 64)))
        near_a, near_b = (pivots.nearest_pivots(x, points) for x in (a, b))
        shared = np.array([len(set(x) & set(y)) for x, y in zip(near_a, near_b, strict=True)])
        assert (shared >= pivots.SHARED).mean() > 0.999


def test_vectors_in_a_narrow_cone():
    """Where all vectors are alike there are pivots enough still, and near ones share them."""
    rng = np.random.default_rng(2)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    center = rng.standard_normal(64) * 1.5
    sample, a = unit(center + rng.standard_normal((1024, 64))), unit(center + rng.standard_normal((1500, 64)))
    assert (a[:200] @ a[:200].T).mean() > 0.6
    points = pivots._spread_out(sample, 512)
    assert len(points) > 400
    aside = rng.standard_normal(a.shape)
    aside = unit(aside - (aside * a).sum(1, keepdims=True) * a)
    near_a, near_b = (pivots.nearest_pivots(x, points) for x in (a, 0.98 * a + math.sqrt(1 - 0.98**2) * aside))
    shared = np.array([len(set(x) & set(y)) for x, y in zip(near_a, near_b, strict=True)])
    assert (shared >= pivots.SHARED).mean() > 0.999
    others = np.array([len(set(x) & set(y)) for x, y in zip(near_a, np.roll(near_a, 1, axis=0), strict=True)])
    assert (others >= pivots.SHARED).mean() < 0.2


def test_nearest_pivots_in_steps(monkeypatch):
    rng = np.random.default_rng(3)
    x, points = rng.standard_normal((300, 8)), rng.standard_normal((40, 8))
    wanted = np.argsort(-(x @ points.T), axis=1, kind="stable")[:, : pivots.NEAREST]
    monkeypatch.setattr(pivots, "_PRODUCT_BYTES", 8 * 40 * 7)
    assert (pivots.nearest_pivots(x, points) == wanted).all()
    assert (pivots.nearest_pivots(x, points[:5]) == np.argsort(-(x @ points[:5].T), axis=1)).all()


def test_links_planted_among_many_vectors(spark, scratch):
    """20,000 vectors in groups and alone; every pair of a label by brute force."""
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((400, 64))
    vectors = np.concatenate([
        np.repeat(centers, 5, axis=0) + rng.normal(0, 0.1, (2000, 64)), np.repeat(centers[:100], 20, axis=0) + rng.normal(0, 0.14, (2000, 64)),
        rng.standard_normal((16_000, 64)),
    ]).astype(np.float32)
    labels = rng.integers(0, 3, len(vectors))
    rows = spark.createDataFrame([(i, v.tolist(), int(n)) for i, (v, n) in enumerate(zip(vectors, labels, strict=True))], FIELDS)
    found = {r.vec_id: r.n_links for r in pivots.nearest_links(rows, scratch).collect()}
    wanted = np.zeros(len(vectors), dtype=int)
    x = vectors.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for label in range(3):
        own = np.flatnonzero(labels == label)
        wanted[own] = ((x[own] @ x[own].T) >= 0.98).sum(axis=1) - 1
    assert wanted.sum() > 2000
    lost = sum(wanted) - sum(found.values())
    assert 0 <= lost <= 0.001 * sum(wanted)
