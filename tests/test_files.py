"""Sources, assembly of rankings, and sinks."""

import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from builders import article, articles
from quillrank import sinks
from quillrank.operators import analysis, assembly, bloom
from quillrank.schema import ARTICLE, HIT
from quillrank.sources import files, tables

GOOD = {
    "id": "a1", "article_url": "http://x/1", "title": "One", "author": "Ann", "published_date": 1325379405000,
    "contents": [{"content": "Text", "subtype": "paragraph", "type": "sanitized_html", "mime": "text/html", "new": 1},
                 {"fullcaption": "cap", "imageHeight": 600, "type": "image"}, None],
    "type": "article", "source": "paper",
}


def lines(tmp_path, *rows):
    path = tmp_path / "articles.jl"
    path.write_text("\n".join(row if isinstance(row, str) else json.dumps(row) for row in rows))
    return str(path)


def test_articles_from_json_lines(spark, tmp_path):
    path = lines(tmp_path, GOOD, {"id": "a2"})
    for df in (files.read_articles(spark, path), files.parse_articles(files.read_lines(spark, path))):
        one, two = sorted(df.collect(), key=lambda row: row["id"])
        assert (one["title"], one["published_date"], one["source"]) == ("One", 1325379405000, "paper")
        assert one["contents"][0]["content"] == "Text"
        assert one["contents"][1]["imageHeight"] == "600"
        assert one["contents"][2] is None
        assert two["title"] is None and two["contents"] is None
    stamped = files.with_published_at(df).where("id = 'a1'").first()
    assert stamped["published_at"].year == 2012


def test_malformed_lines(spark, tmp_path):
    path = lines(tmp_path, GOOD, '{"id": "a2", "title"')
    for read in (lambda mode: files.read_articles(spark, path, mode),
                 lambda mode: files.parse_articles(files.read_lines(spark, path), mode)):
        with pytest.raises(Exception, match="(?i)malformed"):
            read("FAILFAST").collect()
        kept = {row["_corrupt_record"] for row in read("PERMISSIVE").collect()}
        assert kept == {None, '{"id": "a2", "title"'}


def test_unknown_fields(spark, tmp_path):
    path = lines(tmp_path, GOOD, {"id": "a2", "extra": 1})
    found = files.read_lines(spark, path)
    assert files.parse_articles(found).count() == 2
    with pytest.raises(PySparkException, match="extra"):
        files.parse_articles(found, unknown_fields="fail").collect()
    known = files.read_lines(spark, lines(tmp_path, GOOD))
    assert files.parse_articles(known, unknown_fields="fail").count() == 1


def test_queries_from_lines(spark, tmp_path):
    path = tmp_path / "queries.list"
    path.write_text("James Bond\nfacebook ipo\nfacebook ipo\n")
    rows = files.read_queries(spark, str(path)).orderBy("query_id").collect()
    assert [row["query"] for row in rows] == ["James Bond", "facebook ipo", "facebook ipo"]
    assert len({row["query_id"] for row in rows}) == 3


def test_query_numbers_that_outlive_their_file(spark, tmp_path):
    path = tmp_path / "queries.list"
    path.write_text("James Bond\nfacebook ipo\nfacebook ipo\n")
    first = {r["query"]: r["query_id"] for r in files.read_queries(spark, str(path), numbers="text").collect()}
    files.read_lines(spark, str(path)).repartition(3).write.text(str(tmp_path / "again"))
    again = files.read_queries(spark, str(tmp_path / "again"), numbers="text").collect()
    assert len(again) == 2 and {r["query"]: r["query_id"] for r in again} == first
    with pytest.raises(ValueError, match="numbers"):
        files.read_queries(spark, str(path), numbers="luck")


def test_tables_as_articles(spark):
    documents = spark.createDataFrame(
        [(7, "Title line\n\nfirst\nsecond", "s1"), (8, "", "s2")], "doc_id long, text string, source string")
    seven, eight = tables.documents_as_articles(documents).orderBy("id").collect()
    assert (seven["id"], seven["title"], seven["source"]) == ("7", "Title line", "s1")
    assert [(b["content"], b["subtype"]) for b in seven["contents"]] == [("first", "paragraph"), ("second", "paragraph")]
    assert eight["title"] == "" and eight["contents"] == []
    html = ('<html><title>A &amp; B</title><script>var t="</p><p>no";</script><body><p>one <b>bold</b>'
            '<P class="x">two</p>outside<p>three</article>foot</body></html>')
    page = tables.pages_as_articles(spark.createDataFrame([(1, "http://u", html)], "page_id long, url string, html string"))
    assert page.schema == ARTICLE or page.columns == ARTICLE.fieldNames()
    row = page.first()
    assert row["title"] == "A & B" and row["article_url"] == "http://u"
    assert [" ".join(b["content"].split()) for b in row["contents"]] == ["one bold", "two", "three"]


def test_conversations_as_articles(spark):
    rows = [(1, turn, "user" if turn % 2 else "assistant", f"turn {turn}") for turn in range(1, 9)]
    rows += [(1, 0, "system", "be brief"), (1, 2, "tool", None), (2, 3, "user", None), (2, 4, "user", "later"), (3, 1, None, "who")]
    found = tables.conversations_as_articles(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert found.columns == ARTICLE.fieldNames()
    one, two, three = found.orderBy("id").collect()
    assert [(b["subtype"], b["content"]) for b in one["contents"]] == [
        ("system", "be brief"), ("paragraph", "turn 1"), ("paragraph", "turn 2"), ("tool", None), ("paragraph", "turn 3"),
        ("paragraph", "turn 4"), ("paragraph", "turn 5")]
    assert one["title"] == "turn 3" and two["title"] is None and three["title"] is None
    assert [(b["subtype"], b["content"]) for b in two["contents"]] == [("paragraph", None), ("paragraph", "later")]
    text = {r["id"]: r["text"] for r in analysis.article_text(found).collect()}
    assert text == {"1": "turn 3\nturn 1\nturn 2\nturn 3\nturn 4\nturn 5"}


HITS = [
    (1, "red a/b", 1, "x", "Title X", 2.5), (1, "red a/b", 2, "y", "Title Y", 0.0),
    (2, "red a/b", 1, "y", "Title Y", float("-inf")),
]


def hits(spark):
    return spark.createDataFrame(HITS, HIT)


def test_assembly(spark):
    rows = articles(spark, [article("x", "Title X"), article("y", "Title Z", source="late"),
                            article("y", "Title Y", source="early"), article("z", "Title Z")])
    assert {r["id"] for r in assembly.result_ids(hits(spark)).collect()} == {"x", "y"}
    assert sorted(r["id"] for r in assembly.result_articles(hits(spark), rows).collect()) == ["x", "y", "y"]
    first, second = assembly.document_rankings(hits(spark), rows).orderBy("query_id").collect()
    assert [(r["rank"], r["docid"], r["article"]["title"], r["score"]) for r in first["results"]] == [
        (1, "x", "Title X", 2.5), (2, "y", "Title Y", 0.0)]
    assert len(second["results"]) == 1
    up = assembly.ascending(hits(spark)).where("query_id = 1").first()
    assert [(r["score"], r["id"]) for r in up["results"]] == [(0.0, "y"), (2.5, "x")]


def test_many_ids_drop_other_articles_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(assembly, "_IDS", 0)
    rows = spark.range(40_000).selectExpr(
        *[("cast(id as string)" if f.name == "id" else f"cast(null as {f.dataType.simpleString()})") + f" as {f.name}" for f in ARTICLE])
    wanted = spark.range(0, 40_000, 20).selectExpr("id % 7 as query_id", "cast(id as string) as id")
    found = assembly.result_articles(wanted, rows)
    assert found.count() == 2000
    filtered = bloom.may_have_partner(rows, wanted.select("id").distinct(), "id")
    assert 2000 <= filtered.count() <= 1.1 * 2000
    assert "getbit" in found._jdf.queryExecution().executedPlan().toString()
    assert assembly.result_articles(wanted.where("false"), rows).isEmpty()
    monkeypatch.setattr(bloom, "_MOST_BITS", 1 << 10)
    assert bloom.may_have_partner(rows, wanted.select("id").distinct(), "id") is rows
    assert assembly.result_articles(wanted, rows).count() == 2000


def test_rendering(spark):
    texts = {r["query_id"]: r["text"] for r in assembly.rendered(hits(spark)).collect()}
    assert texts == {
        1: "red a/b\n  1:x 2.5 Title X\n  2:y 0.0 Title Y\n",
        2: "red a/b\n  1:y -Infinity Title Y\n",
    }
    fixed = assembly.rendered(hits(spark), decimals=3).where("query_id = 1").first()["text"]
    assert "1:x 2.500 Title X" in fixed


def test_sinks(spark, tmp_path):
    sinks.write_rendered(hits(spark), str(tmp_path / "text"))
    written = {p.parent.name: p.read_text() for p in Path(tmp_path / "text").glob("query_id=*/*.txt")}
    assert written == {
        "query_id=1": "red a/b\n  1:x 2.5 Title X\n  2:y 0.0 Title Y\n",
        "query_id=2": "red a/b\n  1:y -Infinity Title Y\n",
    }
    sinks.write_rendered(hits(spark), str(tmp_path / "few"), per_query=False)
    few = "".join(p.read_text() for p in sorted(Path(tmp_path / "few").glob("*.txt")))
    assert few == written["query_id=1"] + written["query_id=2"]
    for kind in ("parquet", "json"):
        sinks.write_hits(hits(spark), str(tmp_path / kind), kind)
        back = spark.read.format(kind).load(str(tmp_path / kind))
        assert back.count() == 3
        assert {r["file_name"] for r in back.collect()} == {"red_a/b"}
