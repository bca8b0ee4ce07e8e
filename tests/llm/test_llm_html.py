"""Main text of pages: layouts, broken markup, odd rows, and every page of the given table."""

import html
import re

import pytest

from cohort_engine.llm.html_text import LABELLED, block_features, content_tree, extract_text, main_text, text_blocks

TREE = content_tree()


def text(page):
    return main_text(page, TREE)


def test_article_layout():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav>
      <div class="ad">Buy the very best of all things here today and tomorrow.</div>
      <article><h1>A title &amp; more</h1><p>First&nbsp;paragraph   of\n text<br>goes on.<p>Second <b>one</b> with a <a href=x>link</a> in it.</p>
      <aside>See also the other text that is long enough to be one.</aside><p>End.</p></article>
      <form><label>Your name</label><input></form><script>var a = "<p>not text</p>";</script>
      <section class="comments"><article><p>I liked this one very much, thank you for writing it down.</p></article></section>
      <footer>&copy; someone, all rights reserved, in every country there is</footer></body></html>"""
    assert text(page) == "A title & more\n\nFirst paragraph of text goes on.\n\nSecond one with a link in it.\n\nEnd."


def test_layout_without_article():
    page = """<body><div id=header><a href=/>Site</a> the site with the long claim that nobody reads</div><div class="cookie-notice">We use cookies to make
      this site better for you and for all of our partners.</div><div><h2>The heading of the text</h2><p>A paragraph that is long enough to be taken
      for the content of this page, since it has no links.</p><p>Another paragraph which goes on about the same thing for a while longer.</p></div>
      <div class="sidebar"><p>Something beside the text that could be taken for it, were it not for its place.</p></div>"""
    got = text(page).split("\n\n")
    assert len(got) == 3 and got[0] == "The heading of the text"


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p><div>", ""), ("<script>x", ""), ("<!-- never closed <p>x</p>", ""),
    ("<article><p>a &lt; b &amp;amp; c &#233; &eacute; &nope; &am", "a < b &amp; c é é &nope; &am"),
    ("<ARTICLE><P CLASS='x>y'>one<P>two</ARTICLE>", "one\n\ntwo"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("</div></nav><article></p><p>stray ends</p>", "stray ends"),
    ("<nav><article><p>inside an open menu</p></article>", "inside an open menu"),
    ("<article><p>cut off in a ta<b", "cut off in a ta"),
    ("<article><p>a<!-- x --> b<style>c</style></p><noscript>turn it on</noscript></article>", "a b"),
])
def test_broken_markup(page, want):
    assert text(page) == want


def test_long_and_hostile_pages():
    assert text("<article>" + "<p>one two three</p>" * 30_000).count("one two three") == 30_000
    assert text("<a \"" * 20_000) is not None and text("<" * 50_000) is not None and text("<div>" * 20_000 + "x") is not None


def test_tree_learns_its_table_and_neighbours_count():
    import numpy as np
    data = np.array(LABELLED, float)
    assert (TREE.predict(data[:, :-1]) == data[:, -1]).all()
    x = block_features(text_blocks("<p>a b c</p><p><a>d e</a></p><p>f</p>"))
    assert x[1, :6].tolist() == [2, 1, 3, 0, 1, 0]


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract_text(pages).collect()}
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(x for x in parts if x)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>x y</p></article>", "t", 5), (1, "u", "<article><p>x y</p></article>", "t", 5), (None, None, None, None, None)],
                               "page_id long, url string, html string, text string, n_chars long")
    got = extract_text(df).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "x y", 3), (1, "x y", 3)]
    assert extract_text(df.limit(0)).count() == 0


def boilerplate_leaves(tree, low, high):
    """The boilerplate leaves that some block with features between ``low`` and ``high`` reaches."""
    if tree.low is None:
        return [] if tree.label else [(low, high)]
    f, t = tree.feature, tree.threshold
    below = boilerplate_leaves(tree.low, low, high[:f] + (min(high[f], t),) + high[f + 1:]) if low[f] <= t else []
    return below + (boilerplate_leaves(tree.high, low[:f] + (max(low[f], t),) + low[f + 1:], high) if high[f] > t else [])


def test_no_leaf_drops_unlinked_article_blocks():
    most = 1e9
    assert boilerplate_leaves(TREE, (1, 0, 0, 0, 0, 0, 0, 1, 0, 0), (most, .5, most, 1, most, 1, 0, 1, 1, 1)) == []
    assert boilerplate_leaves(TREE, (25, 0, 0, 0, 0, 0, 0, 0, 0, 0), (most, .25, most, 1, most, 1, 0, 0, 1, 1)) == []
    assert boilerplate_leaves(TREE, (50, 0, 0, 0, 0, 0, 0, 1, 0, 0), (most, 1, most, 1, most, 1, 0, 1, 0, 0)) == []


MENU = "<ul><li><a href=/>Home of it</a><li><a href=/n>All the news</a></ul>"


@pytest.mark.parametrize("words", [1, 3, 6, 20, 60, 200, 3000])
@pytest.mark.parametrize("after", [MENU, "<nav>" + MENU + "</nav>", "<p>See <a href=x>this other text</a></p>", "", "<p><a href=x>next page</a></p>"])
def test_article_text_between_a_short_heading_and_links(words, after):
    body = " ".join(f"word{i}" for i in range(words))
    assert body in text(f"<article><h1>Short title</h1><p>{body}</p></article>{after}").split("\n\n")
    if words >= 60:
        assert body in text(f"<body><h2>Short title</h2><p>{body}</p>{after}").split("\n\n")


LONG = " ".join(f"word{i}" for i in range(40))


@pytest.mark.parametrize("attributes", ["class='overflow-hidden main'", 'style="overflow:hidden"', 'aria-hidden="false"', 'data-hidden="1"', 'title="hidden"',
                                        "style='visibility:visible; x-display:none'", "data-state=hidden", 'data-class="banner"'])
@pytest.mark.parametrize("name", ["article", "div", "p"])
def test_shown_blocks_stay(name, attributes):
    assert text(f"<body><h2>A heading of some words</h2><{name} {attributes}>{LONG}</{name}>").endswith(LONG)


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", "class=x hidden", "aria-hidden=true", 'style="color:red; DISPLAY : none"', "\nhidden"])
def test_hidden_blocks_go(attributes):
    assert text(f"<body><article><h1>Title</h1><p>{LONG}</p></article><div {attributes}>{LONG} again</div>") == f"Title\n\n{LONG}"


def test_formulas_are_inline_text():
    formula = "<math><semantics><mi>E</mi><mo>=</mo><mi>m</mi><annotation encoding='application/x-tex'>E=m \\x</annotation></semantics></math>"
    assert text(f"<article><p>So {formula} holds.</p><p>And <annotation>more</annotation> text.</p></article>") == "So E=m holds.\n\nAnd more text."
    assert text("<article><p>a <math><mi>x</mi><annotation>cut</math> b</p></article>") == "a x b"


EIGHTY = " ".join(f"word{i}" for i in range(80))


@pytest.mark.parametrize("page,want", [
    (f"<body><form id=aspnetForm><div class=content><h1>Heading words</h1><p>{EIGHTY}</p></div></form>", f"Heading words\n\n{EIGHTY}"),
    (f"<body><form id=aspnetForm><input type=hidden><div class=content><h1>Heading words</h1><p>{EIGHTY}</p></div></form>", f"Heading words\n\n{EIGHTY}"),
    (f'<body class="has-header"><h1>Heading words of it</h1><p>{EIGHTY}</p>', f"Heading words of it\n\n{EIGHTY}"),
    (f'<body class="header sidebar"><h1>Heading words of it</h1><p>{EIGHTY}</p>', f"Heading words of it\n\n{EIGHTY}"),
    (f'<article class="post form social"><p>{EIGHTY}</p></article>', EIGHTY),
    (f'<article><p>Start of the text.</p><p class="legal">{EIGHTY}</p></article>', f"Start of the text.\n\n{EIGHTY}"),
    ("<p>Hello there.</p>", "Hello there."), ("Just some plain text", "Just some plain text"),
    ("<div><p>Two short</p><p>ones here</p></div>", "Two short\n\nones here"),
    (f"<article><p>Before it.</p><p><a href=x>{EIGHTY}</a></p></article>", f"Before it.\n\n{EIGHTY}"),
    (f"<div class='no-sidebar'><p>{EIGHTY}</p></div><div class='widget'><p>Short words in a box.</p></div>", EIGHTY),
    (f"<div class='page-header'><p>{EIGHTY}</p></div>", EIGHTY),
])
def test_ordinary_pages_keep_their_text(page, want):
    assert text(page) == want


def test_a_list_of_references_is_text():
    page = f"<article><h1>Title</h1><p>{EIGHTY}</p><h2>References</h2><ol><li><a href=1>First work, 1999</a><li><a href=2>Second work, 2001</a></ol><h2>More</h2><ul><li><a href=x>Next</a><li><a href=y>Other</a></ul></article>"
    assert text(page).split("\n\n")[:5] == ["Title", EIGHTY, "References", "First work, 1999", "Second work, 2001"] and "Next" not in text(page)


@pytest.mark.parametrize("box", ['<div class="cookie-notice">', '<div id="siteFooter">', '<div class="x sidebar-left">', "<nav>", "<footer>", '<section class="comments">', '<div role=complementary>',
                                 '<div class="ad-box">', "<form><input><label>"])
def test_boilerplate_beside_an_article_goes(box):
    side = "We have something to say here that is not the text of this page at all and goes on."
    assert text(f"<body>{box}<p>{side}</p></div></nav></footer></section></form></div><div><article><h1>Title</h1><p>{EIGHTY}</p></article></div>") == f"Title\n\n{EIGHTY}"


def test_pages_of_boilerplate_alone():
    assert text("<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav>") == ""
    assert text("<div hidden>not to be seen by anybody at all who reads this page here</div>") == ""
