"""Main text of pages."""

import html
import re

import pytest
from llm_rows import read_rows

from quillrank.llm.html import extract, main_text
from quillrank.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
LINE = "The house of the sea is in the hills and the wind was in the trees of that land for the whole of the day. "
RUSSIAN = "Дом у моря стоит на холмах, и ветер шумел в деревьях той земли весь долгий день, пока не стемнело. "


def article_of(page):
    """What the given pages have between <article> and its end, tags taken out."""
    found = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", page, re.S)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", found[1])).split()) if found else ""


def test_query_gives_the_articles(spark):
    pages = {p: (u, h) for p, u, h in read_rows(SF, "pages", ["page_id", "url", "html"])}
    rows = LLM_QUERIES["op8_html_text"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        url, page = pages[r.page_id]
        assert (r.url, r.text, r.n_chars) == (url, article_of(page), len(r.text))


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<<<>>>", ""),
    ("<article><p>Short.</p></article>", "Short."),
    (f"<nav><a href=x>Home</a></nav><p>{LINE}</p><footer>&copy; me</footer>", LINE.strip()),
    (f"<article><h1>Title</h1><p>{LINE}<p>Yes.<p>{LINE}</article>", f"Title {LINE}Yes. {LINE}".strip()),
    (f"<main><p>{LINE}</p><div class='comments'><p>{LINE}</p></div></main>", LINE.strip()),
    (f"<div class='sidebar'><p>{LINE}</p></div><div id=content><p>{LINE}</p></div>", LINE.strip()),
    (f"<form><p>{LINE}</p></form><script>var a = '<p>{LINE}</p>';</script><style>p {{}}</style><p>{LINE}</p>", LINE.strip()),
    (f"<!-- <p>{LINE}</p> --><div class=cookie-notice><p>{LINE}</p></div><article>a &amp; b &lt;c&gt;\n\n d&#233;</article>", "a & b <c> dé"),
    (f"<p>{LINE}</p><p><a href=1>{LINE}</a></p>", LINE.strip()),
    (f"<article><header><h1>Big news</h1></header><p>{LINE}</p></article>", f"Big news {LINE}".strip()),
    (f"<header><h1>Site</h1></header><article><p>{LINE}</p><aside>{LINE}</aside></article>", LINE.strip()),
    (f"<article><p>{LINE}</p><script>unclosed", LINE.strip()),
    (f"<div style='overflow:hidden'><p>{LINE}</p></div>", LINE.strip()),
    (f"<div aria-hidden='false'><p>{LINE}</p></div><div aria-hidden=true><p>{LINE}</p></div>", LINE.strip()),
    (f"<div hidden><p>{LINE}</p></div><div style='color: red; display: none'><p>{LINE}</p></div><p>{LINE}</p>", LINE.strip()),
    (f"<div class='page has-sidebar'><article><p>{LINE}</p></article></div>", LINE.strip()),
    (f"<div class='site no-sidebar with-comments'><p>{LINE}</p><div class='site-footer'><p>{LINE}</p></div></div>", LINE.strip()),
    (f"<svg/><p>{LINE}</p><svg><text>no</text></svg>", LINE.strip()),
    (f"<iframe src=x><article><p>{LINE}</p></article><iframe><p>{LINE}</p>", f"{LINE}{LINE}".strip()),
    (f"<head><script>var a = 1;</head><body><p>{LINE}</p></body>", LINE.strip()),
    (f"<p class='advert'>{LINE}</p><p>{LINE}</p><p class=advert>{LINE}<p>{LINE}", f"{LINE}{LINE}".strip()),
    (f"<article><p>{LINE}</p><ul><li class='comment'><div><p>{LINE}</p></div><li class='comment'>{LINE}</ul><p>{LINE}</p></article>", f"{LINE}{LINE}".strip()),
    (f"<ul><li class='comment'>{LINE}<li>{LINE}</ul><p>{LINE}</p>", f"{LINE}{LINE}".strip()),
    (f"<p title='a > b' data-x=\"1>0\">{LINE}</p>", LINE.strip()),
    (f"<p class=\"broken>{LINE}</p><p>{LINE}</p>", f"{LINE}{LINE}".strip()),
    (f"<nav><a href=1>Меню</a></nav><p>{RUSSIAN}</p><footer>Все права</footer>", RUSSIAN.strip()),
    (f"<article><ul><li>One<li>Two</ul><p>{LINE}</p></article>", f"One Two {LINE}".strip()),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_short_blocks_inherit_from_the_nearest():
    page = f"<div><p>{LINE}</p><p>Near text.</p></div><div class='ad'>{LINE}</div><div><p>Near nothing.</p></div>"
    assert main_text(page) == f"{LINE}Near text.".strip()


def test_long_page():
    assert main_text("<article>" + f"<p>{LINE}</p>" * 5000) == " ".join([LINE.strip()] * 5000)


def test_pages_that_open_much_and_close_nothing():
    for tag in ("<iframe>", "<div>", "<p class='advert'>", "<svg>", "<p title='", "<a href=\"", "<!--", "</div>"):
        assert isinstance(main_text(tag * 20_000 + f"<p>{LINE}</p>"), str)


def test_odd_rows(spark):
    rows = [(1, None, None, "own"), (None, "u", f"<p>{LINE}</p>", None), (2, "u", "", "x"), (2, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    assert sorted(map(repr, map(tuple, extract(pages).collect()))) == sorted(map(repr, [
        (1, None, ""), (None, "u", LINE.strip()), (2, "u", ""), (2, "u", "")
    ]))
    assert extract(pages.limit(0)).isEmpty()
