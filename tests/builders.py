"""Small articles and queries for tests."""

from quillrank.schema import ARTICLE, QUERY


def block(content, subtype="paragraph"):
    row = dict.fromkeys(ARTICLE["contents"].dataType.elementType.fieldNames())
    return {**row, "content": content, "subtype": subtype}


def article(id, title, *paragraphs, contents=None, **fields):
    row = dict.fromkeys(ARTICLE.fieldNames())
    given = [block(text) for text in paragraphs] if contents is None else contents
    return {**row, "id": id, "title": title, "contents": given, "published_date": 0, **fields}


def articles(spark, rows):
    return spark.createDataFrame(rows, ARTICLE)


def queries(spark, *texts):
    return spark.createDataFrame([(i, text) for i, text in enumerate(texts, 1)], QUERY)


def ranked(hits):
    """{query_id: [(id, score), ...] in rank order}"""
    found = {}
    for row in sorted(hits.collect(), key=lambda row: (row["query_id"], row["rank"])):
        found.setdefault(row["query_id"], []).append((row["id"], row["score"]))
    return found
