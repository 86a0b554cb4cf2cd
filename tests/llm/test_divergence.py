"""The audit of sources against plain counting, and the tree against whole matrices."""

import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pytest
from llm_rows import ALPHABET, documents

from quillrank.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FIELDS = "text string, lang string, source string"


def found_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_counting(rows, least=30, top=50):
    counts, documents_of = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        own = found_terms(text)
        counts[lang or "", source or ""].update(own)
        documents_of[lang or ""].update(set(own))
    wanted = set()
    for lang, frequencies in documents_of.items():
        kept = [t for t, n in frequencies.items() if n >= least]

        def prices(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        groups = {s: c for (of, s), c in counts.items() if of == lang}
        priced = {s: prices(c) for s, c in groups.items()}
        whole = prices(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(-sum(abs(priced[s][t] - priced[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            wanted |= {(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)}
            above = [(whole[t] - priced[s][t], t.encode(), t) for t in kept if groups[s][t] and priced[s][t] > whole[t]]
            wanted |= {(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(above)[:top], 1)}
    return wanted


@pytest.mark.parametrize(("tile", "cells"), [(128, 1 << 17), (3, 400)])
def test_documents_against_counting(spark, scratch, monkeypatch, tile, cells):
    monkeypatch.setattr(divergence, "_TILE", tile)
    monkeypatch.setattr(divergence, "_CELLS", cells)
    given = documents(spark, "/root/testdata/sf0.01")
    rows = [tuple(r) for r in given.select("text", "lang", "source").collect()]
    found = divergence.audit(given, scratch).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == by_counting(rows)


def test_small_groups_and_few_terms(spark, scratch):
    rng = np.random.default_rng(4)
    words = ["The", "the", "Ä", "ä", "x_y", "a1b", "漢字", "É", "é", "z"]
    rows = [(" ".join(rng.choice(words, 6)), f"l{i % 2}", f"s{rng.integers(5)}") for i in range(80)]
    rows += [(None, "l0", "silent"), ("", None, None), ("only here", "l9", "a"), ("only here", "l9", None)]
    found = divergence.audit(spark.createDataFrame(rows, FIELDS), scratch, least_documents=5, top_terms=3).collect()
    assert {tuple(r) for r in found} == by_counting(rows, 5, 3)
    assert {r.item for r in found if (r.lang, r.source, r.part) == ("l9", "a", "pair")} == {""}


def test_odd_rows(scratch, odd_documents, no_documents):
    rows = [tuple(r) for r in odd_documents.select("text", "lang", "source").collect()]
    found = divergence.audit(odd_documents, scratch, least_documents=2).collect()
    assert {tuple(r) for r in found} == by_counting(rows, 2)
    assert divergence.audit(no_documents, scratch).isEmpty()


def test_terms_in_pieces(monkeypatch):
    rng = np.random.default_rng(9)
    text = "".join(rng.choice(ALPHABET, 3000))
    wanted = [t.encode() for t in found_terms(text)]
    assert list(chain(*divergence.terms(text.encode()))) == wanted
    monkeypatch.setattr(divergence, "_PIECE", 7)
    assert list(chain(*divergence.terms(text.encode()))) == wanted
    assert list(divergence.terms(b"")) == []


@pytest.mark.parametrize("front", [1 << 20, 16])
@pytest.mark.parametrize(("groups", "columns", "share"), [(1, 5, 0.5), (2, 1, 1.0), (7, 90, 0.1), (20, 33, 0.9), (33, 6, 0.02)])
def test_corrections_against_the_whole_matrix(monkeypatch, groups, columns, share, front):
    monkeypatch.setattr(divergence, "_FRONT", front)
    rng = np.random.default_rng(groups)
    zero = rng.integers(1, 100, groups)
    matrix = np.repeat(zero[:, None], columns, axis=1)
    rows, places = np.nonzero(rng.random((groups, columns)) < share)
    if not len(rows):
        rows, places = np.array([0]), np.array([columns - 1])
    prices = rng.integers(1, 10**9, len(rows))
    matrix[rows, places] = prices
    for across in [None, *([groups // 2] if groups > 1 else [])]:
        a, b, added = divergence.pair_corrections(rows, places, prices, zero, across)
        found = dict(zip(zip(a.tolist(), b.tolist(), strict=True), added.tolist(), strict=True))
        for i in range(groups):
            for j in range(i + 1, groups):
                if across is not None and not i < across <= j:
                    assert (i, j) not in found
                    continue
                apart = int(np.abs(matrix[i] - matrix[j]).sum())
                assert found.get((i, j), 0) + columns * abs(int(zero[i]) - int(zero[j])) == apart


def test_tree_holds_its_cells():
    rows, columns = np.array([0, 5, 5, 2]), np.array([3, 0, 6, 3])
    tree = divergence.QuadTree(rows, columns)
    assert tree.height == 3
    met = set()
    for row in range(8):
        for column in range(8):
            at = np.zeros(1, dtype=np.int64)
            for depth in range(3):
                bit = 2 - depth
                at = tree.child(depth, at, np.int64(2 * (row >> bit & 1) + (column >> bit & 1)))
            if at[0] >= 0:
                met.add((row, column))
                assert (rows[tree.order][at[0]], columns[tree.order][at[0]]) == (row, column)
    assert met == set(zip(rows.tolist(), columns.tolist(), strict=True))
