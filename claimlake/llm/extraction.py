"""Main text of HTML pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element, in page order. Lines inside
menus, headers, footers, sidebars, notices, adverts, forms and comment sections,
and lines outside an article that consist of links, weigh nothing; so do lines
outside the article where a page marks one. The weights are summed over sliding
windows, which pass over noise. A surge is where the sums rise above a threshold,
the dive where they fall to zero. The lines between are the main text, all
stretches in page order, with the lighter parts that stand in the same elements.
Where articles are marked, all their lines are, but for those of teasers: short
articles with a line of links beside an article that is none. A paragraph that is a
link belongs to the text it stands in; a list of links does not. Titles inside a header,
the article's own included, are headers. Lines are joined by empty lines.

Class names are weak evidence: see ``_is_noise``. Tags are found and elements matched in
one pass each, so work grows with the page, however it is nested or broken.

A null or empty page has an empty text. A null id or url is carried; repeated
rows give repeated rows; an empty table gives no rows. Whole pages are read.
Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import BATCH_ROWS, text_or_empty

# Elements of HTML by their part in a page.
RAW = ("script", "style", "noscript", "template", "svg", "math", "textarea", "title", "iframe", "object", "select")
NOISE = ("head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset")
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that may be left open; their ends are implied.
LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option optgroup html body b i em strong a span u".split())
NOISE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|sponsored|promo|promotion|cookies?|consent|gdpr|"
    r"notices?|popup|modal|newsletter|subscribe|subscription|signup|nav|navbar|navigation|menu|breadcrumbs?|sidebar|"
    r"side|aside|widgets?|related|recommended|share|sharing|social|comments?|respond|replies|disqus|footer|header|"
    r"masthead|toolbar|pagination|pager|login|search|alert|skip)(?:$|[\s_-])",
    re.I,
)
COMMENT_NAMES = re.compile(r"(?:^|[\s_-])(?:comments?|respond|replies|disqus)(?:$|[\s_-])", re.I)
#: Class names that say what a text is about or how it is filed, not what it is in the page.
FILING_NAMES = re.compile(r"(?<!\S)(?:category|cat|tag|topic|section|post|type|format|status|author)-\S*", re.I)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
_TAG = re.compile(
    r"<!--.*?(?:-->|$)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>]*/>|[^>]*>.*?(?:</(?P=raw)\s*>|$))"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>=]++|=\s*\"[^\"]*+\"|=\s*'[^']*+'|=)*+)>"
    r"|<[!?][^>]*>",
    re.I | re.S,
)
#: The same without regard to quotation marks, for pages that leave one open.
_BARE_TAG = re.compile(
    rf"<!--.*?(?:-->|$)|<(?P<raw>{'|'.join(RAW)})\b(?:[^>]*/>|[^>]*>.*?(?:</(?P=raw)\s*>|$))"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>[^>]*)>|<[!?][^>]*>",
    re.I | re.S,
)
_TAG_START = re.compile(r"</?[a-z]", re.I)
_ATTRIBUTE = re.compile(r"([a-z:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass(frozen=True)
class ExtractionParams:
    window: int = 3
    #: Characters a window must hold for a surge on a page that marks no article.
    surge: int = 80
    #: Lines with more than this share of link text weigh nothing outside articles.
    max_link_share: float = 0.6
    #: An article with a line of links is a teaser if its other lines hold no more characters than this.
    teaser: int = 300


@dataclass
class Line:
    text: str
    link_chars: int
    noise: bool
    article: int  # number of the article it is in, 0 for none
    element: int  # number of the innermost element it is in that must be closed, 0 for none
    paragraph: bool  # whether it is a p element


@dataclass
class Element:
    """An element of a page that is not loose, with what it holds."""

    name: str
    attributes: str
    start: int  # number of its tag
    chars_before: int
    end: int = 0  # number of the tag that ends it
    closed: bool = False  # whether that is its own end tag
    chars: int = 0


def tags(page: str) -> Iterator[re.Match]:
    """The tags, comments and raw elements of a page, in one pass.

    A tag that no ``>`` ends outside quotation marks means that a mark was left open; from
    there on marks are not looked at.
    """
    at, last, pattern = 0, page.rfind(">"), _TAG
    while 0 <= (at := page.find("<", at)):
        if at > last and not page.startswith("<!--", at):
            return
        found = pattern.match(page, at)
        if found is None and pattern is _TAG and _TAG_START.match(page, at):
            pattern = _BARE_TAG
            found = pattern.match(page, at)
        if found is None:
            at += 1
        else:
            yield found
            at = found.end()


def _pushed(tag: re.Match) -> str:
    """The name of an element that has to be closed, if the tag starts or ends one."""
    name = (tag["name"] or "").lower()
    return "" if name in VOID or name in LOOSE and name not in ("li", "td", "p", "span") else name


def elements_of(page: str, found: list[re.Match]) -> tuple[dict[int, Element], int]:
    """Elements by the number of their tag, and the characters of text on the page."""
    elements: dict[int, Element] = {}
    stack: list[Element] = []
    open_names: Counter = Counter()
    chars, at = 0, 0
    for number, tag in enumerate(found):
        chars += len(page[at : tag.start()].strip())
        at = tag.end()
        name = _pushed(tag)
        if not name:
            continue
        if not tag["close"]:
            if not ((tag["attrs"] or "").endswith("/") and name not in BLOCKS):
                stack.append(Element(name, tag["attrs"] or "", number, chars))
                elements[number] = stack[-1]
                open_names[name] += 1
        elif open_names[name]:  # an end tag without a start ends nothing
            while True:
                ended = stack.pop()
                open_names[ended.name] -= 1
                ended.end, ended.chars = number, chars - ended.chars_before
                if ended.name == name:
                    ended.closed = True
                    break
    chars += len(page[at:].strip())
    for left in stack:
        left.end, left.chars = len(found), chars - left.chars_before
    return elements, chars


def _is_noise(element: Element, chars: int) -> bool:
    """Whether an element is no part of the text, by its name, its role or its class.

    Class names tell little: those that file a text under something do not count, articles
    are not judged by them, nor are elements that hold most of the page. Reader comments are
    comments whatever their length.
    """
    name, attributes = element.name, element.attributes
    if name in NOISE:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in attributes.lower().split() or found.get("aria-hidden") == "true":
        return True
    if found.get("role", "").lower() in NOISE_ROLES:
        return True
    named = FILING_NAMES.sub(" ", f"{found.get('class', '')} {found.get('id', '')}")
    if COMMENT_NAMES.search(named):
        return True
    return name != "article" and 2 * element.chars <= chars and bool(NOISE_NAMES.search(named))


def _is_article(name: str, attributes: str) -> bool:
    return name in ("article", "main") or (
        "=" in attributes and bool(re.search(r"articlebody|role\s*=\s*[\"']?main", attributes, re.I))
    )


def page_lines(page: str) -> list[Line]:
    """The lines of a page: the text of its block elements, in order."""
    lines: list[Line] = []
    parts: list[str] = []
    found = list(tags(page))
    elements, chars = elements_of(page, found)
    ends = Counter(e.end for e in elements.values())
    links, link, article, articles, numbers, block = 0, 0, 0, 0, 0, ""
    # open elements: (element, is noise, article number, own number)
    stack: list[tuple[Element, bool, int, int]] = []
    noise = closed_noise = 0

    def close_line() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            own = stack[-1][3] if stack else 0
            lines.append(Line(text, links, noise > 0, article, own, block == "p"))
        parts.clear()
        links = 0

    def leave(index: int) -> None:
        nonlocal noise, closed_noise, article
        for element, was_noise, *_ in stack[index:]:
            noise -= was_noise
            closed_noise -= was_noise and element.closed
        del stack[index:]
        article = stack[-1][2] if stack else 0

    at = 0
    for number, tag in enumerate(found):
        if tag.start() > at:
            text = page[at : tag.start()]
            parts.append(text)
            links += len(text) if link else 0
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            if tag["raw"] is None and tag[0].startswith("<!"):
                continue
            parts.append(" " if (tag["raw"] or "").lower() in ("select", "iframe", "object") else "")
            continue
        if name == "a":
            link = 0 if tag["close"] else 1
        if name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            close_line()
            link, block = 0, "" if tag["close"] else name
        if ends[number]:
            ended = len(stack)
            while ended and stack[ended - 1][0].end <= number:
                ended -= 1
            leave(ended)
        element = elements.get(number)
        if element is None:
            continue
        bad = _is_noise(element, chars)
        if name in LOOSE and not bad:
            continue
        starts = not bad and _is_article(name, element.attributes)
        if starts and noise and not closed_noise:
            leave(next(i for i, s in enumerate(stack) if s[1]))  # left open by mistake
        if starts and not noise and not article:
            articles += 1
            article = articles
        noise += bad
        closed_noise += bad and element.closed
        numbers += 1
        stack.append((element, bad, article, numbers))
    if at < len(page):
        parts.append(page[at:])
    close_line()
    return lines


def _of_links(line: Line, params: ExtractionParams) -> bool:
    return line.link_chars > params.max_link_share * len(line.text)


def _articles(lines: list[Line], params: ExtractionParams) -> list[Line]:
    """The lines of marked articles; of teasers only if there is nothing else."""
    with_links: set[int] = set()
    chars: dict[int, int] = {}
    for line in lines:
        chars.setdefault(line.article, 0)
        if _of_links(line, params):
            with_links.add(line.article)
        else:
            chars[line.article] += len(line.text)
    full = {n for n in chars if n not in with_links or chars[n] > params.teaser}
    return [line for line in lines if not full or line.article in full]


def _stretches(lines: list[Line], params: ExtractionParams) -> list[Line]:
    """The lines between surges and dives, and those that share an element with them."""
    weights = [0 if _of_links(line, params) else len(line.text) for line in lines]
    sums = [sum(weights[i : i + params.window]) for i in range(len(weights))]
    inside, i = set(), 0
    while i < len(sums):
        if sums[i] > params.surge:
            while i < len(sums) and sums[i] > 0:  # until the dive
                inside.add(i)
                i += 1
        else:
            i += 1
    elements = {lines[i].element for i in inside if weights[i]}
    # a page too short to surge is one text
    return [
        line
        for i, line in enumerate(lines)
        if (weights[i] or line.paragraph and inside) and (not inside or i in inside or line.element in elements)
    ]


def main_text(page: str | None, params: ExtractionParams = ExtractionParams()) -> str:
    lines = [line for line in page_lines(page or "") if not line.noise]
    marked = [line for line in lines if line.article]
    chosen = _articles(marked, params) if marked else _stretches(lines, params)
    return "\n\n".join(line.text for line in chosen)


def extract(
    pages: DataFrame,
    params: ExtractionParams = ExtractionParams(),
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """The id, the url, ``text`` and ``n_chars`` of every row of ``pages``."""
    source = pages.select(id_column, url_column, text_or_empty(html_column).alias("stripped"))
    names = [id_column, url_column, "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = [main_text(page, params) for page in part.column(2).to_pylist()]
                made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names=names)

    schema = source.select(id_column, url_column).schema
    return source.mapInArrow(run, schema.add("text", "string").add("n_chars", "long"))
