import html
import math
import random
import re

import pandas as pd
import pytest

from lowfold.llm import html_text
from lowfold.llm.html_text import extract

LONG = " ".join(["A sentence with enough words to be dense, and then some more words to follow it."] * 4)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just words &amp; more", "just words & more"),
        ("<p>one<p>two<br>three&nbsp;four", "one\n\ntwo three four"),
        ("<script>if(a<b){'</p>'}</script><style>p{}</style><!-- no --><p>yes</p>", "yes"),
        ('<a href="x>y">a link</a> and <b>bold <i>text', "a link and bold text"),
        ("<h1>T &#x41;&eacute;</h1><p>a\n  b\t c</p>", "T Aé\n\na b c"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>yes</p>", "yes"),
    ],
)
def test_small_pages(page, text):
    assert extract(page) == text


def test_parts_that_are_not_the_article():
    page = f"""<html><head><title>no</title></head><body><header><a href=/>Site</a></header><nav><ul><li><a href=/a>a</a></li></ul></nav>
      <div class="cookie-notice">{LONG}</div><div id="main"><div class="post"><h1>Head</h1><p>{LONG}</p><p>Short.</p><ul><li>x y</li><li>z</li></ul>
      <div class="share"><a href=1>s</a></div></div><aside>{LONG}</aside><div class="sidebar">{LONG}</div></div>
      <section id="comments"><p>{LONG}{LONG}</p></section><form>{LONG}<input></form><footer>{LONG}</footer></body></html>"""
    assert extract(page) == "\n\n".join(["Head", LONG, "Short.", "x y", "z"])


def test_dense_neighbours_without_an_article_element():
    page = f"<body><div><p>{LONG}</p></div><div><p>{LONG} b</p></div><div><a href=a>link one</a> <a href=b>link two</a></div></body>"
    assert extract(page) == f"{LONG}\n\n{LONG} b"


P = f"<p>{LONG}</p>"
MENU = '<div><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li><li><a href="/c">Three</a></li></ul></div>'


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # Densities choose the article in <main>, not the teasers or the comments beside it.
        (f'<body>{MENU}<main><div><p>Teaser <a href=x>read more here</a></p><p>Teaser two <a href=y>read it here</a></p></div><article><h1>T</h1>{P}{P}</article><div class="comment">{P}</div></main></body>', ["T", LONG, LONG]),
        (f"<body><main><h1>T</h1><div>{P}{P}</div><div><a href=1>One more</a> <a href=2>Two more</a></div></main></body>", ["T", LONG, LONG]),
        # A form around the page is the page; its fields and other forms are not.
        (f'<body><form id="aspnetForm"><input type="hidden" name="v">{MENU}<div><h1>T</h1>{P}{P}</div><button>Go</button></form></body>', ["T", LONG, LONG]),
        (f"<body><div>{P}{P}</div><form><p>Your name please</p><input name=a></form></body>", [LONG, LONG]),
        # Names that only hold such a word.
        (f'<body><div id="banner-content">{P}{P}</div></body>', [LONG, LONG]),
        (f'<body><div id="discussion-board">{P}{P}</div></body>', [LONG, LONG]),
        (f'<article><h1>T</h1>{P}<section id="related-work"><h2>Related work</h2>{P}</section><section id="discussion"><h2 id="discussion">Discussion</h2>{P}</section></article>', ["T", LONG, "Related work", LONG, "Discussion", LONG]),
        (f'<article><h2 id="discussion">Discussion</h2>{P}</article>', ["Discussion", LONG]),
        (f'<body><div class="site-nav-left">{P}</div><div>{P}{P}</div><div class="related-posts">{P}</div><div class="reader-comments comment-42">{P}</div></body>', [LONG, LONG]),
        (f'<body><div>{P}{P}</div><div class="discussion-board"><p>{LONG}</p><textarea></textarea></div></body>', [LONG, LONG]),
        # Linked titles and a paragraph of links stay, menus go.
        (f"<article>{P}<ul>{'<li><a href=r>A long and winding title of a work</a></li>' * 5}</ul></article>", [LONG, *["A long and winding title of a work"] * 5]),
        (f"<article>{P}<p><a href=1>Part one</a> and <a href=2>Part two</a></p>{MENU}</article>", [LONG, "Part one and Part two"]),
        # Attribute values of any length.
        (f'<body><div data-page="{"<p>x</p>" * 4000}">{P}</div></body>', [LONG]),
    ],
)
def test_names_forms_links_and_attributes(page, text):
    assert extract(page) == "\n\n".join(text)


def _plain(node, linked=False):
    """Characters, those in links, tags and links of a node, by recursion; and the same of each node, in page order."""
    tag, inner = node
    c = l = t = k = 0
    below = []
    for part in inner:
        if isinstance(part, str):
            c += len(part)
            l += len(part) * linked
        else:
            (c1, l1, t1, k1), rest = _plain(part, linked or part[0] == "a")
            c, l, t, k = c + c1, l + l1, t + t1 + 1, k + k1 + (part[0] == "a")
            below.append(rest)
    return (c, l, t, k), ((c, l, t, k), below)


@pytest.mark.parametrize("seed", range(30))
def test_densities_against_recursion(seed):
    draw = random.Random(seed)

    def tree(depth):
        parts = [("x" * draw.randrange(1, 90)) if draw.random() < 0.5 or not depth else tree(depth - 1) for _ in range(draw.randrange(1, 5))]
        return (draw.choice(["div", "section", "span", "b"]), parts) if draw.random() < 0.8 else ("a", ["y" * draw.randrange(1, 40)])

    def markup(node):
        return f"<{node[0]}>" + "".join(p if isinstance(p, str) else markup(p) for p in node[1]) + f"</{node[0]}>"

    body = ("body", [tree(4) for _ in range(3)])
    page = html_text.Page(markup(body))
    density, total, *_ = html_text._densities(page)
    numbers, shape = _plain(body)
    share = numbers[1] / max(1, numbers[0])

    def one(c, l, t, k):
        if not c:
            return 0.0
        value = c / max(1, l) * max(1, t) / max(1, k)
        base = math.log(c / max(1, c - l) * l + share * c + math.e)
        return c / max(1, t) * (math.log(value, base) if base > 1.0000001 else math.log(value + 1)) if value > 0 else 0.0

    expected = []

    def walk(shape):
        expected.append((one(*shape[0]), sum(one(*b[0]) for b in shape[1])))
        for below in shape[1]:
            walk(below)

    walk(shape)
    found = list(zip(density, total, strict=True))[1:]
    assert len(found) == len(expected) and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for f, e in zip(found, expected, strict=True) for x, y in zip(f, e, strict=True))


@pytest.mark.parametrize("page", ["<a x='" * 9000 + "\"" + ">" * 9000, "<" * 9000, '<a "' * 9000, "<div>" * 9000 + "x", "<b>" * 9000 + "x", "<a x='" * 9000 + ">", "&" * 9000, "<!--" * 9000, "</p>" * 9000, "<p>" * 9000 + "x"])
def test_broken_pages_take_little_time(page):
    extract(page)


def test_given_pages():
    pages = pd.read_parquet("/root/testdata/sf0.001/pages.parquet")
    for page in pages.html:
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", inner)]
        assert extract(page) == "\n\n".join(b for b in blocks if b)


def test_table(spark):
    schema = "page_id BIGINT, url STRING, html STRING, text STRING, n_chars STRING"
    rows = [(1, None, None, "clash", "x"), (2, "u", "<p>a</p>", None, None), (2, "u", "<p>a</p>", None, None), (None, "u", f"<article>{LONG * 3000}</article>", "c", "c")]
    out = html_text.texts(spark.createDataFrame(rows, schema), name="main")
    assert out.columns == ["page_id", "url", "html", "text", "n_chars", "main"]
    assert sorted(len(r.main) for r in out.collect()) == [0, 1, 1, 3000 * len(LONG)]
    assert html_text.texts(spark.createDataFrame([], schema)).count() == 0
