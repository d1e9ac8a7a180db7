"""Odd pages, names that are hints, copies, and a plain counter of templates."""

import time
from collections import defaultdict

import pytest

from panelmill.llm import templates
from panelmill.llm.common import prepare


def text(html):
    return templates.main_text(html, set())


def test_deep_pages():
    for levels in (1500, 5000):
        assert text("<article>" + "<div>x" * levels + "</div>" * levels + "<p>end</p></article>").endswith("\n\nend")
        assert text("<b><i>" * levels + "deep") == "deep"
    begin = time.perf_counter()
    long = "<article>" + "<div>" * 800 + "word " * 20_000 + "</div>" * 800 + "</article>"
    assert text(long) == " ".join(["word"] * 20_000) and time.perf_counter() - begin < 2
    assert len(text("<p>" + "a b <br>" * 300_000).split()) == 600_000


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<article><p title=it's>Hello world. It's good.</p><p>Second</p></article>", "Hello world. It's good.\n\nSecond"),
        ("<article><p title=it's>Hello</p></article>", "Hello"),
        ("<article><p title='a > b' x=\"c > d\">in</p></article>", "in"),
        ("<article><p title = 'a > b'>in</p><a href=x'y>link</a></article>", "in\n\nlink"),
        ("<article><p data-x=\"it's\">one</p> it's two</article>", "one\n\nit's two"),
        ("<article><p a=\"open>text</p></article>", "text"),
        ("<p>1 < 2 and <3 & 4 &lt; 5", "1 < 2 and <3 & 4 < 5"),
        ("<!-- <p>no</p> --><p>yes<!-- x", "yes"),
    ],
)
def test_tags(html, expected):
    assert text(html) == expected


PROSE = "This paragraph has more than a few words and is plainly part of the article."


@pytest.mark.parametrize(
    "inner, stays",
    [
        (f'<p class="related-work">{PROSE}</p>', True),
        (f'<p class="notice">{PROSE}</p>', True),
        (f'<p id="share">{PROSE}</p>', True),
        (f'<section class="related-work"><h2>Related work</h2><p>{PROSE}</p></section>', True),
        (f'<div class="sidebar"><p>{PROSE}</p></div>', False),
        (f'<div class="comment-list"><p>{PROSE}</p></div>', False),
        ('<p class="notice">We use cookies.</p>', False),
        ('<div class="share-buttons">Share this</div>', False),
        ('<div class="related-links">' + "".join(f'<a href="/{k}">Another story of interest {k}</a> ' for k in range(6)) + "</div>", False),
        (f"<aside>{PROSE}</aside>", False),
        (f'<div role="navigation">{PROSE}</div>', False),
        (f'<div style="display: none">{PROSE}</div>', False),
    ],
)
def test_names_inside_an_article(inner, stays):
    got = text(f"<html><body><div class=ad>Buy</div><article><p>Begin.</p>{inner}<p>End.</p></article><footer>F</footer></body></html>")
    assert got.startswith("Begin.") and got.endswith("End.") and (got != "Begin.\n\nEnd.") == stays


def pages_of(spark, rows):
    return prepare(spark).createDataFrame(rows, "page_id long, url string, html string")


def story(k, n=30):
    return f"Story {k} " + " ".join(f"word{k}x{i}" for i in range(n))


def test_copies_keep_their_text(spark):
    """Ten copies of an article on a host of twenty pages, and rows that repeat."""
    rows = [(k, f"http://h.example/{k}", f"<article><h1>Copy</h1><p>{story(0)}</p></article>") for k in range(10)]
    rows += [(10 + k, f"http://h.example/{10 + k}", f"<article><h1>T{k}</h1><p>{story(k + 1)}</p></article>") for k in range(10)]
    rows += [rows[0]] * 12
    got = {r["page_id"]: r["text"] for r in templates.extract(pages_of(spark, rows)).collect()}
    assert all(got[k] == f"Copy\n\n{story(0)}" for k in range(10)) and all(got[10 + k] == f"T{k}\n\n{story(k + 1)}" for k in range(10))


def test_furniture_of_unknown_names_goes_by_recurrence_alone(spark):
    """Pages without an article element and with names of no list, against a plain counter of templates."""
    rows = []
    for k in range(24):
        promo = f'<div class="zz-{k % 2}"><span>Our spring offer ends on Friday, do not miss it.</span></div>'
        rows.append((k, f"http://plain.example/{k}", f'<body><div class="q1"><b>Site of things</b> all day</div>{promo}<div class="q2"><p>{story(k)}</p><p>Short {k}.</p></div></body>'))
    got = {r["page_id"]: r["text"] for r in templates.extract(pages_of(spark, rows)).collect()}
    blocks = {i: text(html).split("\n\n") for i, _, html in rows}
    seen = defaultdict(set)
    for i, parts in blocks.items():
        for b in parts:
            seen[b].add(i)
    plain = {i: "\n\n".join(b for b in parts if len(seen[b]) < 12) for i, parts in blocks.items()}
    assert got == plain and all("offer" not in t and "Site" not in t for t in got.values()) and all(f"Short {k}." in got[k] for k in got)


def test_a_hint_and_two_articles_are_enough(spark):
    rows = [(k, f"http://h.example/{k}", f'<article><p>{story(k)}</p><p class="notice">{PROSE if k < 2 else PROSE + str(k)}</p></article>') for k in range(30)]
    got = {r["page_id"]: r["text"] for r in templates.extract(pages_of(spark, rows)).collect()}
    assert all((PROSE in got[k]) == (k >= 2) for k in got)
