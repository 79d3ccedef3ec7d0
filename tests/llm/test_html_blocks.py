"""HTML extraction (3): hand pages, the labelled table, and every page of the given table."""

import html
import re
import time

import pytest
from helpers import TESTDATA

from growthledger.llm.html_blocks import (
    Split, _keeps, extract, features, labelled_pages, labelled_tree, main_text, text_blocks,
)

SF_SMALL = f"{TESTDATA}/sf0.001"
TREE = labelled_tree()
PROSE = "It was late in the year when the river rose, and nobody in the town had seen so much water before."


def f1(pages):
    """Harmonic mean of precision and recall over the blocks of marked pages."""
    found = [(_keeps(TREE, r), b.keep) for blocks in map(text_blocks, pages)
             for b, r in zip(blocks, features(blocks).tolist(), strict=True)]
    right = sum(kept and wanted for kept, wanted in found)
    return 2 * right / (sum(kept for kept, _ in found) + sum(wanted for _, wanted in found))


def test_tree_on_its_table_and_on_held_out_pages():
    assert f1(labelled_pages()) > 0.99
    assert f1(labelled_pages(seed=99, pages=200, styles="p")) > 0.98  # no sign of place at all
    assert f1(labelled_pages(seed=98, pages=200, styles="stc")) > 0.98


def test_tree_uses_words_and_link_density_of_block_and_neighbours():
    def used(node):
        return {node.feature} | used(node.low) | used(node.high) if isinstance(node, Split) else set()

    assert {1, 2} <= used(TREE)
    assert used(TREE) & {3, 4, 5, 6}


@pytest.mark.parametrize(
    "page, kept",
    [
        (f"<p>{PROSE}</p><p>So it ended.</p><p>{PROSE}</p>", [PROSE, "So it ended.", PROSE]),
        (f"<p>{PROSE}</p><p>{'<a href=1>one two three</a> ' * 8}</p>", [PROSE]),
        (f"<p>Menu</p><p><a href=1>Weather today</a></p><div>{PROSE}</div><p>Us</p><p><a href=2>Imprint</a></p>"
         "<p>All rights reserved</p>", [PROSE]),
        (f"<table><tr><td><a href=1>Front page</a> <a href=2>Archive</a></td></tr></table><p>{PROSE} <a href=4>More</a>"
         f"</p><p>{PROSE}</p><p><a href=5>Next page</a></p><p><a href=6>Terms</a> | <a href=7>Privacy</a></p>",
         [f"{PROSE} More", PROSE]),
        (f"<body class=has-sidebar><div class=header-image>{PROSE}</div><p class=form-factor>{PROSE}</p>"
         f"<div class=sidebarBox>{PROSE}</div><div class='related-stories'>{PROSE}</div>", [PROSE, PROSE]),
        (f"<main><p>{PROSE}</p><ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a></ul><p>{PROSE}</main>",
         [PROSE, PROSE]),
        ("<html><head><title>T</title><meta a=b><body><article><p>Here</p></article>", ["Here"]),
        (f"<head><svg><p>{PROSE}</p><p>{PROSE}", [PROSE, PROSE]),
        ('<article><p title="a>b">one</p><p title="c>two</p><p>three</article>', ["one", "two", "three"]),
    ],
)
def test_plain_and_broken_pages(page, kept):
    assert main_text(page, TREE) == "\n\n".join(kept)


@pytest.mark.parametrize(
    "piece", ["<a ", '<a ">" ', "<a '>", "<svg>", "<title>x", "</script ", "<script></script ", "<!--", "<a \"'>", "<", "&"]
)
def test_broken_markup_takes_linear_time(piece):
    start = time.process_time()
    text_blocks(piece * 100_001)
    assert time.process_time() - start < 5


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("<", ""), ("<!-- x", ""), ("<p>x<script>var t='</p>", ""),
        ("<title>t</title><article>a&nbsp;&lt;b&gt; &#233;<br>c<ul><li>q<li>r</ul></article>", "a <b> é c\n\nq\n\nr"),
        ("<article><p>one<div id=comments><p>bad</p></div><p>two</article><footer>x</footer>", "one\n\ntwo"),
        ("<ARTICLE><P CLASS='x'>O<B>n</B>e &amp;amp; two\n\t three</ARTICLE><div class=ad>buy</div>", "One &amp; two three"),
        ("<nav><a href='>'>m</a></nav><main><h1>H</h1><p title=\"it's\">p</p></main>", "H\n\np"),
        ("<article><header><h1>H</h1></header><p>t</p><form>f <input></form><style>p{}</style></article>", "H\n\nt"),
        ("<main><p>t</main><div role=complementary>s</div><div class='site-notice'>n</div>", "t"),
    ],
)
def test_hand_pages(page, text):
    assert main_text(page, TREE) == text


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    found = {r.page_id: r for r in extract(pages).collect()}
    for row in pages.collect():
        article = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")]
        parts = re.split(r"</?p>|</?h1>", re.sub(r"</?b>|<br>", "", article))
        want = "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        assert (found[row.page_id].text, found[row.page_id].n_chars, found[row.page_id].url) == (want, len(want), row.url)


def test_nulls_repeats_and_clashing_columns(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"
    rows = [(1, "u", None, 9), (1, "u", None, 9), (None, None, "<main>x</main>", 9), (2, "u", long, 9), (3, "u", "", 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    want = [(1, "u", "", 0)] * 2 + [(2, "u", "\n\n".join(["word & word"] * 30_000), 389_998), (3, "u", "", 0)]
    assert sorted(tuple(r) for r in found.where("page_id IS NOT NULL").collect()) == want
    assert [tuple(r) for r in found.where("page_id IS NULL").collect()] == [(None, None, "x", 1)]
    assert extract(pages.limit(0)).count() == 0
