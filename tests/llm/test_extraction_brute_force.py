"""Extraction against a parser that builds the whole tree, class names that are none of its business, broken pages."""

import random
import time
from html.parser import HTMLParser

import pytest

from claimlake.llm import extraction
from claimlake.llm.extraction import BLOCKS, NOISE, VOID

BODY = "<p>" + "The long text of the article goes on and on for many words. " * 5 + "</p><p>Second.</p>"
PAGE = "<html><body><nav><a href='/'>Home</a></nav>{}<footer>the end</footer></body></html>"


class Tree(HTMLParser):
    """A well-formed page as nested lists: [name, class, children]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ["", "", []]
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs).get("class", ""), []]
        self.open[-1][2].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        assert self.open.pop()[0] == tag

    def handle_data(self, data):
        self.open[-1][2].append(data)


def plain_text(page):
    """Lines inside articles and outside noise, by walking the tree."""
    tree, lines, parts = Tree(), [], []
    tree.feed(page)

    def size(node):
        return sum(len(c.strip()) if isinstance(c, str) else size(c) for c in node[2])

    def end(inside):
        text = " ".join("".join(parts).split())
        parts.clear()
        if text and inside:
            lines.append(text)

    def walk(node, inside, noise):
        name, classes, children = node
        block = name in BLOCKS
        noise = noise or name in NOISE or "comments" in classes.split()
        noise = noise or (name != "article" and "sidebar" in classes.split() and 2 * size(node) <= size(tree.root))
        inside = inside or (name == "article" and not noise)
        for child in children:
            if isinstance(child, str):
                parts.append(child)
            elif child[0] in BLOCKS:
                end(inside and not noise)
                walk(child, inside, noise)
            elif child[0] == "br":
                parts.append(" ")
            elif child[0] not in extraction.RAW:
                walk(child, inside, noise)
        if block:
            end(inside and not noise)

    walk(tree.root, False, False)
    return "\n\n".join(lines)


def page(rng):
    def text():
        return " ".join(rng.choices(["word", "a&amp;b", "x &lt; y", "naïve", "<b>bold</b>", "<em>it</em>", "one<br>two", "\n "], k=rng.randrange(1, 9)))

    def blocks(depth):
        out = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.choice(["p", "p", "p", "div", "section", "ul", "aside", "sidebar", "comments", "blockquote", "script"])
            if kind in ("p", "script") or depth == 0:
                out.append(f"<p>{text()}</p>" if kind != "script" else "<script>if (a < b) { '<p>no</p>' }</script>")
            elif kind == "ul":
                out.append("<ul>" + "".join(f"<li>{text()}</li>" for _ in range(3)) + "</ul>")
            elif kind in ("sidebar", "comments"):
                out.append(f"<div class='left {kind}'>{blocks(depth - 1)}</div>")
            else:
                out.append(f"<{kind}>{blocks(depth - 1)}</{kind}>")
        return "\n".join(out)

    # most of the page is outside of any side bar
    return PAGE.format(f"<article>{blocks(3)}<p>{'closing words ' * 900}</p></article>" + blocks(1) * rng.randrange(2))


def test_generated_pages():
    rng = random.Random(12)
    for _ in range(400):
        made = page(rng)
        assert extraction.main_text(made) == plain_text(made), made


@pytest.mark.parametrize(
    "wrap",
    [
        '<article class="post category-social-media">{}</article>', '<article class="tag-search-engines">{}</article>',
        '<article class="category-advertising">{}</article>', '<article class="related-coverage">{}</article>',
        '<article class="story notices">{}</article>', '<div class="search-page"><article>{}</article></div>',
        '<div class="main social"><div id="post">{}</div></div>', '<main class="alert"><article>{}</article></main>',
    ],
)
def test_class_names_do_not_empty_an_article(wrap):
    first = ("The long text of the article goes on and on for many words. " * 5).strip()
    assert extraction.main_text(PAGE.format(wrap.format(BODY))) == f"{first}\n\nSecond."


def test_comments_are_comments_whatever_their_length():
    comment = "<article class='comment'><p>" + "I disagree with every word of this. " * 40 + "</p></article>"
    for wrap in ("<section class='comments'>{}</section>", "{}"):
        got = extraction.main_text(PAGE.format(f"<article>{BODY}</article>" + wrap.format(comment * 5)))
        assert "disagree" not in got and got.endswith("Second.")


def test_a_paragraph_that_is_a_link_stays():
    got = extraction.main_text(PAGE.format(f"<div id='text'>{BODY}<p><a href='/more'>Read the whole report here</a></p>{BODY}</div>"))
    assert "Read the whole report here" in got and "Home" not in got


@pytest.mark.parametrize(
    "broken",
    [
        "<div>" * 40_000 + "</span>" * 40_000, '<a x="' * 100_000, '<a x="' * 100_001 + '">"', "<script " * 100_000,
        "<nav>" + "<article>x</article>" * 20_000, "<div class='ad'>" * 40_000 + "<article>text", "<div>" * 50_000 + "x" + "</div>" * 50_000,
        "<div>" * 20_000 + "<nav>" + "<article></article>" * 20_000 + "</nav>", "<" * 300_000, "<!--" * 100_000, "<p x='" * 50_000 + "<p>text</p>" * 50_000,
    ],
)
def test_broken_pages_take_linear_time(broken):
    start = time.process_time()
    extraction.main_text(broken)
    assert time.process_time() - start < 4
