"""Main text of web pages by block rules in two passes.

The first pass gives every block a class from its markup, stop-word density, length and link density; short
blocks without a clear sign stay undecided. The second pass gives these the class of the nearest decided
neighbours, those of the same section of the page first.
"""

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from quillrank.llm.ids import id_or_mark, id_or_null

SHORT = 70  # characters under which a block is undecided unless its links or markup speak
LONG = 200  # characters from which it is text with half the stop words
STOP_DENSITY = 0.15  # stop words among words from which a block is running text
LINK_DENSITY = 0.33  # characters in links from which it is navigation

# Frequent words of the languages of the corpus.
STOP_WORDS = frozenset("""
the of and to in is that for it as was with be by on not he his this are or had at from which but have an they
you were her all she there would their we him been has when who will more no if out so a
der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie
nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis
de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son aux d l ou
el y los del las una por con no su para es al lo como más o pero sus le ha me si sin sobre este entre cuando muy
""".split())

# Elements that end a block, those whose content is no text, those that hold no article text.
_BLOCK = frozenset("""
address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary
table tbody td tfoot th thead title tr ul
""".split())
_SILENT = frozenset("script style noscript template textarea title svg math iframe object select button".split())
_RAW = frozenset(["script", "style"])  # without an end tag these go on to the end of the head, or of the page
_APART = frozenset(["nav", "footer", "aside", "form", "menu", "dialog", "header", "fieldset"])
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that need no end tag: the next one of their kind ends them, and a paragraph ends with any other block.
_LOOSE = frozenset("p li dt dd option tr td th".split())
_ARTICLE = frozenset(["article", "main"])
_APART_WORD = re.compile(
    r"ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|notice|menu|nav\w*|sidebar|"
    r"comments?|commentlist|disqus|respond|footer|header|masthead|breadcrumbs?|share|social|related|newsletter|"
    r"subscribe|login|signup|popup|modal|widget|pagination|pager|copyright",
    re.I,
)
# A name that begins so tells what a wrapper has around or in it, not what it is.
_STATE = frozenset("has have with without no not is js layout page wrap wrapper".split())
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_UNSHOWN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_TAG_NAME = "[a-zA-Z][a-zA-Z0-9:-]*"
# A bracket in a quoted value ends no tag; where quotes do not match, the first bracket does.
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(/?)({_TAG_NAME})((?:[^>"']++|"[^"<]*+"|'[^'<]*+')*+)>|<(/?)({_TAG_NAME})([^>]*)>|<[!?][^>]*>|</[^>]*>""",
    re.S,
)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in [*_SILENT, "head"]}


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): a or b or c for name, a, b, c in _ATTRIBUTE.findall(text)}


def _names_apart(names: str) -> bool:
    """Whether a class, id or role says that an element is none of the article."""
    for name in names.split():
        words = re.split(r"[-_]+", name)
        if words[0].lower() not in _STATE and any(_APART_WORD.fullmatch(word) for word in words):
            return True
    return False


def _hidden(given: dict[str, str]) -> bool:
    return (
        "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true"
        or bool(_UNSHOWN.search(given.get("style", "")))
    )


@dataclass
class _Block:
    section: int
    apart: bool
    in_article: bool
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    good: bool | None = None


@dataclass
class _Open:
    name: str
    section: int
    apart: bool
    in_article: bool


class _Ends:
    """Where the content of silent elements ends. A kind of end tag that a page has no more of is not sought again."""

    def __init__(self, page: str):
        self._page, self._missing = page, set()

    def _after(self, name: str, at: int) -> int | None:
        if name not in self._missing:
            if found := _ENDS[name].search(self._page, at):
                return found.end()
            self._missing.add(name)
        return None

    def skip(self, name: str, at: int) -> int:
        """The place after the element whose start tag ends at ``at``; an element without end tag has no content, but for scripts and styles."""
        end = self._after(name, at)
        if end is None and name in _RAW:
            end = self._after("head", at) or len(self._page)
        return at if end is None else end


def _blocks(page: str) -> list[_Block]:
    """The text blocks of a page in order. Unclosed and stray tags are borne: an end tag closes up to its start, if open."""
    stack = [_Open("", 0, False, False)]
    blocks: list[_Block] = []
    sections, in_link, heading = 1, False, False
    block = _Block(0, False, False, False)

    def finish() -> None:
        nonlocal block
        if block.parts:
            block.text = " ".join("".join(block.parts).split())
            if block.text:
                blocks.append(block)
        top = stack[-1]
        block = _Block(top.section, top.apart, top.in_article, heading)

    def add(raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            block.parts.append(text)
            if in_link:
                block.linked += len("".join(text.split()))

    at, ends = 0, _Ends(page)
    while token := _TOKEN.search(page, at):
        add(page[at : token.start()])
        at = token.end()
        closing, name, text = (token.group(i) or token.group(i + 3) or "" for i in (1, 2, 3))
        if not name:
            continue
        name = name.lower()
        if name in _SILENT and not closing:
            finish()
            if not text.endswith("/"):
                at = ends.skip(name, at)
            continue
        if name == "a":
            in_link = not closing
            continue
        if name not in _BLOCK:
            continue
        if closing:
            in_link = False
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
            heading = False
            finish()
            continue
        while stack[-1].name in _LOOSE and stack[-1].name in (name, "p"):
            stack.pop()
        top = stack[-1]
        heading = len(name) == 2 and name[0] == "h" and name[1].isdigit()
        if name not in _VOID and not heading:
            given = _attributes(text) if text else {}
            article = name in _ARTICLE
            # The heading part of an article is its own; a page's header is not.
            apart = top.apart or (name in _APART and not (name == "header" and top.in_article))
            if given and not article and name not in ("body", "html"):
                apart = apart or _names_apart(" ".join(given.get(key, "") for key in ("class", "id", "role")))
            apart = apart or _hidden(given)
            if article or name in _APART or name == "section" or apart != top.apart:
                section, sections = sections, sections + 1
            else:
                section = top.section
            if name not in _LOOSE or apart != top.apart:
                stack.append(_Open(name, section, apart, top.in_article or article))
        finish()
    add(page[at:])
    finish()
    return blocks


def _other_script(text: str) -> bool:
    """Whether most letters are of a script without stop words here; such a text is told by its length and links alone."""
    letters = [c for c in text if c.isalpha()]
    return 2 * sum(c > "\u024f" for c in letters) > len(letters)


def _first_pass(block: _Block) -> bool | None:
    """True for text, False for the rest of the page, None for undecided."""
    if block.apart:
        return False
    letters = len(block.text.replace(" ", ""))
    if block.linked > LINK_DENSITY * letters:
        return False
    if block.heading or len(block.text) < SHORT:
        return None
    if _other_script(block.text):
        return True
    words = block.text.lower().split()
    density = sum(word.strip(".,;:!?\"'()") in STOP_WORDS for word in words) / len(words)
    if density >= STOP_DENSITY or (len(block.text) >= LONG and 2 * density >= STOP_DENSITY):
        return True
    return None if block.in_article else False


def _second_pass(blocks: list[_Block]) -> None:
    """Undecided blocks inherit from the nearest decided neighbours of their section, if it has any, else of the page.

    At equal distance text wins. A section of an article without any decided block is text; a page without any
    is no text outside articles.
    """
    decided = [block.good for block in blocks]

    def nearest(members: list[int]) -> dict[int, tuple[float, bool | None]]:
        found: dict[int, tuple[float, bool | None]] = {}
        for line in (members, members[::-1]):
            last = None
            for i in line:
                if decided[i] is not None:
                    last = i
                elif last is not None:
                    distance, value = abs(i - last), decided[last]
                    known = found.get(i, (float("inf"), None))
                    if distance < known[0]:
                        found[i] = (distance, value)
                    elif distance == known[0]:
                        found[i] = (distance, value or known[1])
        return found

    by_section: dict[int, list[int]] = {}
    for i, block in enumerate(blocks):
        by_section.setdefault(block.section, []).append(i)
    near = nearest(list(range(len(blocks))))
    for section, members in by_section.items():
        if section:  # what stands in no section of its own has the whole page for neighbours
            near |= nearest(members)
        if all(decided[i] is None for i in members) and blocks[members[0]].in_article:
            near |= {i: (0, True) for i in members}
    for i, block in enumerate(blocks):
        if block.good is None:
            block.good = bool(near.get(i, (0, False))[1])


def main_text(page: str | None) -> str:
    """The article of a page: text blocks in order, white space inside them single, joined by a space."""
    if not page:
        return ""
    blocks = _blocks(page)
    for block in blocks:
        block.good = _first_pass(block)
    _second_pass(blocks)
    return " ".join(block.text for block in blocks if block.good)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html).

    A null, empty or textless page gives an empty text; null ids and urls stay null; repeated rows are extracted each; other columns
    are not read. Whole pages are read, without shuffle.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({
                "page_id": frame["page_id"], "url": frame["url"], "text": [main_text(page) for page in frame["html"]]
            })

    found = pages.select(id_or_mark("page_id"), "url", "html").mapInPandas(
        rows, "page_id bigint, url string, text string"
    )
    return found.withColumn("page_id", id_or_null("page_id"))
