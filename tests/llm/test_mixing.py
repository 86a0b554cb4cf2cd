"""The mixture against its laws, worked out with fractions."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm_rows import documents

from quillrank.llm import mixing
from quillrank.llm.running import running_totals

SF = "/root/testdata/sf0.001"
FIELDS = "doc_id bigint, text string, source string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def targets_by_rounds(sizes, weights=(5, 2, 1), share=Fraction(3, 2), repeats=2):
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    capped = set()
    while True:
        left = share * sum(sizes.values()) - sum(repeats * sizes[n] for n in capped)
        total = sum(weight[n] for n in names if n not in capped)
        found = {n: Fraction(repeats * sizes[n]) if n in capped else left * weight[n] / total for n in names}
        above = {n for n in names if found[n] > repeats * sizes[n]}
        if not above:
            return found
        capped |= above


def check(rows, repeats=2, **options):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row.source].append(row)
    sizes = {name: sum(r.size for r in own) for name, own in by_source.items()}
    targets = targets_by_rounds(sizes, repeats=repeats, **options)
    for name, own in by_source.items():
        assert {(r.source_size, r.target) for r in own} == {(sizes[name], float(targets[name]))}
        assert abs(sum(r.taken for r in own) - targets[name]) <= Fraction(1, 2)
        assert all(0 <= r.taken <= repeats * r.size for r in own)
        # One document at most is cut, in the epoch after those all have.
        epochs = int(targets[name] / sizes[name]) if sizes[name] else 0
        assert sum(r.taken not in (epochs * r.size, (epochs + 1) * r.size) for r in own) <= 1
    return targets


def test_mixture_of_the_documents(spark, scratch):
    given = documents(spark, SF)
    mixed = mixing.mix(given, scratch)
    rows = mixed.collect()
    texts = {r.doc_id: r.text for r in given.collect()}
    assert {r.doc_id: r.size for r in rows} == {doc: len(words(text)) for doc, text in texts.items()}
    targets = check(rows)
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    assert 0 < sum(targets[name] == 2 * sizes[name] for name in targets) < len(targets)  # some are at their cap
    assert sorted(mixing.mix(given.repartition(7), scratch).collect()) == sorted(rows)
    made = mixing.mixture(given, mixed)
    assert made.columns == given.columns
    taken = Counter()
    for r in made.collect():
        taken[r.doc_id] += len(words(r.text))
        assert words(texts[r.doc_id])[: len(words(r.text))] == words(r.text)
    assert taken == Counter({r.doc_id: r.taken for r in rows})


def test_one_source_with_most_of_the_words(spark, scratch):
    rows = [(i, "w " * (i % 13), "hot" if i % 3 else f"s{i % 7}") for i in range(600)] + [(1000, "long " * 5000, "s1")]
    check(mixing.mix(spark.createDataFrame(rows, FIELDS), scratch).collect())
    given = spark.createDataFrame(rows, FIELDS)
    own = mixing.mix(given, scratch, weights=(1, 4), percent=80, repeats=1).collect()
    check(own, weights=(1, 4), share=Fraction(4, 5), repeats=1)
    with pytest.raises(ValueError, match="share"):
        mixing.mix(given, scratch, percent=250, repeats=2)


def test_odd_rows(spark, scratch, odd_documents, no_documents):
    named = odd_documents.selectExpr("* except (source)", "case when doc_id in (1, 3, 9) then 'a' when doc_id > 6 then 'ä' end as source")
    mixed = mixing.mix(named, scratch)
    rows = mixed.collect()
    check(rows)
    assert sorted((r.doc_id or 0, r.size) for r in rows) == sorted(
        (r.doc_id or 0, len(words(r.text))) for r in odd_documents.select("doc_id", "text").collect()
    )
    made = mixing.mixture(named, mixed)
    assert made.columns == named.columns
    assert sum(len(words(r.text)) for r in made.select("text").collect()) == sum(r.taken for r in rows)
    empty = mixing.mix(no_documents, scratch)
    assert empty.isEmpty() and mixing.mixture(no_documents, empty).isEmpty()
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None), (2, "", None)], FIELDS)
    assert {(r.size, r.source_size, r.target, r.taken) for r in mixing.mix(blank, scratch).collect()} == {(0, 0, 0.0, 0)}


def test_running_totals(spark, scratch):
    rows = spark.range(5000).selectExpr("id % 3 * (id % 2) as g", "hash(id) as k", "id % 17 as v", "id")
    found = running_totals(rows, "g", ["k", "id"], ["v", "id"], scratch).collect()
    assert len(found) == 5000
    sums = defaultdict(lambda: [0, 0])
    for r in sorted(found, key=lambda r: (r.g, r.k, r.id)):
        assert [r.before_v, r.before_id] == sums[r.g]
        sums[r.g][0] += r.v
        sums[r.g][1] += r.id
