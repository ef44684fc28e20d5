"""Articles in several parts."""

from claimlake.llm import extraction

HEAD = "<header><p>Site</p></header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
LONG = "<p>The first part of the article has many words and goes on for more than a surge takes to begin.</p>"
SHORT = "<p>A short last part.</p>"
ADVERT = "<div class='ad'><p>Buy</p><p>now</p><p>here</p><p>today</p></div>"
LINKS = "<ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li><li><a href='/3'>Three</a></li></ul>"


def paragraphs(html):
    return extraction.main_text(f"<body>{HEAD}{html}<footer><p>the end</p></footer></body>").split("\n\n")


def test_boxes_do_not_cut_an_unmarked_article():
    first, last = LONG[3:-4], SHORT[3:-4]
    second = first.replace("first", "second")
    for box in (ADVERT, LINKS, ADVERT + LINKS):
        assert paragraphs(f"<div id='post'>{LONG}{box}{LONG.replace('first', 'second')}</div>") == [first, second]
        assert paragraphs(f"<div id='post'>{LONG}{box}{SHORT}</div>") == [first, last]
        assert paragraphs(f"<div id='post'>{SHORT}{box}{LONG}</div>") == [last, first]


def test_all_parts_of_a_marked_article_but_no_teasers():
    first, last = LONG[3:-4], SHORT[3:-4]
    teaser = "<article><h3><a href='/x'>Another story</a></h3><p>In short.</p></article>"
    assert paragraphs(f"<article>{LONG}</article><article>{SHORT}</article>") == [first, last]
    assert paragraphs(f"<article>{SHORT}</article>{teaser}<article>{LONG}</article>") == [last, first]
    assert paragraphs(teaser + teaser) == ["Another story", "In short."] * 2
