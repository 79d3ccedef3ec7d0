"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page becomes a flat list of blocks, each the text between two block-level tags. A block
is described by its word count and link density, those of the blocks before and after it,
and its place: what the elements around it say about themselves. The tree is trained on
``labelled_pages``, a small table of pages whose article blocks are marked, many of them
without any sign of place; it is the same every time.

The scan is linear: a quote that is never closed is an ordinary character, and where the
quotes of a tag hide every ``>`` up to the end of the page, quotes count for nothing from
there on.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, texts_of, type_of

# Tags that don't end a block.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt rtc ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
# Tags whose content is no text of the page.
SILENT = set(
    "script style noscript template svg math iframe object audio video canvas textarea select button title".split()
)
# Of these, tags whose content goes on to the end of the page without an end tag.
RAW = set("script style".split())
# Tags without content.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Tags and roles of parts that are no article.
OTHER_TAGS = set("nav header footer aside form dialog menu fieldset".split())
OTHER_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu".split())
# What class or id of parts that are no article speak of.
OTHER_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus footer form gdpr header login menu modal nav navbar navigation newsletter notice "
    "notification pagination popup promo promotion replies respond search share sharing sidebar signup social "
    "sponsor subscribe subscription tags toolbar widget widgets".split()
)
# Words that say the same wherever they stand in a name.
OTHER_ANYWHERE = set("promoted recommended related sponsored".split())
# Words at the end of a name that only say what holds the thing.
HOLDERS = set(
    "area bar block body bottom box buttons column container group holder icons inner item items left links list "
    "outer panel right row section slot top unit wrap wrapper".split()
)
# First words of names that speak of the page around, like has-sidebar.
ABOUT = set("has no with without".split())
# Tags that hold an article, and words in class or id that say the same.
ARTICLE_TAGS = {"article", "main"}
ARTICLE_WORDS = set("article content entry main post story".split())
# Places: what tags and roles, or classes and ids, say about a block.
IN_ARTICLE, LIKE_ARTICLE, UNKNOWN, LIKE_OTHER, IN_OTHER = 2, 1, 0, -1, -2

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_SIGNS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_KEEP = re.compile(r"\bdata-keep\b")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    place: int
    keep: bool = False


@dataclass(frozen=True)
class _Part:
    tag: str
    place: int = UNKNOWN
    comments: bool = False
    keep: bool = False


def _speaks_of_other(name: str) -> bool:
    """Whether a class or id names something that is no article: its last word that isn't a mere holder."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[0] in ABOUT:
        return False
    while len(words) > 1 and words[-1] in HOLDERS:
        words.pop()
    return words[-1] in OTHER_WORDS or not OTHER_ANYWHERE.isdisjoint(words)


def _part(tag: str, attributes: str, outer: _Part) -> _Part:
    """What an opening tag says about the blocks inside it."""
    names, roles = [], []
    if "=" in attributes:
        for name, *values in _SIGNS.findall(attributes):
            (roles if name.lower() == "role" else names).extend("".join(values).split())
    keep = outer.keep or bool(_KEEP.search(attributes))
    if tag in ("html", "body", "head"):
        return _Part(tag, keep=keep)
    comments = outer.comments or any(n.lower().startswith("comment") for n in names)
    place = outer.place
    if tag in ARTICLE_TAGS:
        place = IN_OTHER if comments else IN_ARTICLE if tag == "article" else max(place, LIKE_ARTICLE)
    elif place >= UNKNOWN:
        # A heading area inside an article belongs to it.
        by_tag = tag in OTHER_TAGS and not (tag == "header" and place > UNKNOWN)
        if by_tag or not OTHER_ROLES.isdisjoint(r.lower() for r in roles):
            place = IN_OTHER
        elif comments or any(map(_speaks_of_other, names)):
            place = LIKE_OTHER
        elif any(not ARTICLE_WORDS.isdisjoint(w.lower() for w in _WORDS.findall(n)) for n in names):
            place = max(place, LIKE_ARTICLE)
    return _Part(tag, place, comments, keep)


def _markup(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of each tag in order; comments and the like have an empty tag.

    The receiver may send a position to go on from.
    """
    at, quoted = 0, True
    last = {mark: page.rfind(mark) for mark in ">\"'"}
    while (start := page.find("<", at)) >= 0 and (page.startswith("<!--", start) or start < last[">"]):
        at = start + 1
        slash = tag = attributes = ""
        if page.startswith("!--", at):
            end = page.find("-->", at + 3) + 3
            end = end if end > 2 else len(page)
        elif page[at] in "!?":
            end = page.find(">", at) + 1
        elif name := _NAME.match(page, at):
            slash, tag = name.groups()
            end, k = 0, name.end()
            while quoted and (stop := _STOP.search(page, k)):
                mark, k = stop[0], stop.end()
                if mark == ">":
                    end = k
                    break
                if k <= last[mark]:
                    k = page.find(mark, k) + 1
            if not end:
                quoted = False
                end = page.find(">", name.end()) + 1
            attributes = page[name.end() : end - 1]
        else:
            continue
        at = end
        again = yield start, end, slash, tag.lower(), attributes
        if again is not None:
            at = again
            yield start, end, "", "", ""  # answers send()


def text_blocks(page: str) -> list[Block]:
    """The blocks of a page in order, white space inside them being single spaces."""
    blocks: list[Block] = []
    open_parts, open_tags = [_Part("")], Counter()
    pieces: list[tuple[str, bool]] = []
    never_closed: set[str] = set()
    linked, at = False, 0

    def finish() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
            if text:
                part = open_parts[-1]
                inside = html.unescape(" ".join(p for p, in_link in pieces if in_link))
                words = len(text.split())
                blocks.append(Block(text, words, min(words, len(inside.split())), part.place, part.keep))
            pieces.clear()

    def leave(k: int) -> None:
        open_tags.subtract(p.tag for p in open_parts[k:])
        del open_parts[k:]

    markup = _markup(page)
    for start, end, closing, tag, attributes in markup:
        if start > at:
            pieces.append((page[at:start], linked))
        at = end
        if not tag:
            continue
        if tag == "a":
            linked = not closing
        if tag == "br":
            pieces.append((" ", linked))
            continue
        if tag in INLINE:
            continue
        if tag in SILENT and not closing:
            # To its end tag; without one only script and style go on. A self-closing one is empty.
            if not attributes.endswith("/") and tag not in never_closed:
                ending = re.compile(rf"</{tag}\b", re.I).search(page, at)
                gt = page.find(">", ending.end()) + 1 if ending else 0
                if gt or tag in RAW:
                    at = gt or len(page)
                    markup.send(at)
                else:
                    never_closed.add(tag)
            if tag not in ("button", "svg", "math", "canvas"):
                finish()
            continue
        finish()
        if closing:
            linked = False
            if open_tags[tag]:
                leave(next(k for k in range(len(open_parts) - 1, 0, -1) if open_parts[k].tag == tag))
        elif tag not in VOID:
            if tag in ("p", "li", "td", "tr", "dt", "dd", "option") and open_parts[-1].tag == tag:
                leave(len(open_parts) - 1)  # its end tag may be left out
            elif open_parts[-1].tag == "p":
                leave(len(open_parts) - 1)
            open_parts.append(_part(tag, attributes, open_parts[-1]))
            open_tags[tag] += 1
    if at < len(page):
        pieces.append((page[at:], linked))
    finish()
    return blocks


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: place, then (words, link density) of it, the one before and the one after."""
    own = np.array([[b.words, b.linked / b.words] for b in blocks], float).reshape(-1, 2)
    none = np.zeros((1, 2))
    before, after = np.vstack([none, own[:-1]]), np.vstack([own[1:], none])
    place = np.array([[b.place] for b in blocks], float).reshape(-1, 1)
    return np.hstack([place, own, before[: len(own)], after[: len(own)]])


_PROSE = "it was late in the year when the river rose and nobody in the town had seen so much water before".split()


def labelled_pages(seed: int = 1, pages: int = 240, styles: str = "stcppp") -> list[str]:
    """The labelled table, made by rule; data-keep marks article blocks.

    Styles: ``s`` articles and other parts by tag, ``t`` a main part with other parts by
    class, ``c`` everything by class, ``p`` plain blocks without any sign.
    """
    rng = random.Random(seed)

    def text(low: int, high: int) -> str:
        return " ".join(rng.choice(_PROSE) for _ in range(rng.randint(low, high)))

    def link(low: int = 1, high: int = 4) -> str:
        return f"<a href=x>{text(low, high)}</a>"

    def block(inside: str, keep: str = "") -> str:
        tag = rng.choice(["p", "div", "li", "td"])
        return f"<{tag}{keep}>{inside}</{tag}>"

    def links(low: int = 3) -> str:
        """A menu: a block per link, or one block of links."""
        if rng.random() < 0.5:
            return "".join(block(link()) for _ in range(rng.randint(low, 7)))
        return block(rng.choice([" ", " | "]).join(link() for _ in range(rng.randint(low, 9))))

    def article(keep: str, link_alone: bool) -> str:
        parts = [block(text(3, 14), keep)] if rng.random() < 0.8 else []  # a heading
        for k in range(rng.randint(2, 7)):
            parts.append(block(text(25, 120) + rng.choice(["", "", f" {link()} {text(8, 20)}"]), keep))
            if k and rng.random() < 0.5:
                parts.append(block(text(1, 10), keep))
                parts.append(block(text(25, 90), keep))
            if link_alone and rng.random() < 0.3:
                parts += [block(link(2, 6), keep) for _ in range(rng.randint(1, 4))]
        return "".join(parts)

    def other() -> str:
        return rng.choice([links(), block(text(4, 30)), block(text(30, 90)), block(text(20, 40)) + links()])

    table = []
    for k in range(pages):
        style, keep = styles[k % len(styles)], " data-keep"
        short = "".join(block(text(1, 9), keep) for _ in range(rng.randint(1, 4)))
        if style == "s":
            before = [f"<nav>{links()}</nav>", f"<header>{other()}</header>"]
            main = f"<article>{rng.choice([article(keep, True) + short, article(keep, True), short])}</article>"
            after = [f"<aside>{other()}</aside>", f"<form>{block(text(2, 30))}</form>", f"<footer>{other()}</footer>"]
        elif style == "t":
            before = [f"<div class=menu>{links()}</div>", f"<div class=banner>{other()}</div>"]
            main = rng.choice([links() + article(keep, False), article(keep, False) + short, short])
            if rng.random() < 0.3:  # a menu in the midst
                main = article(keep, False) + links() + block(text(12, 90), keep)
            main = f"<main>{main}</main>"
            after = [f"<div class=ad>{other()}</div>", f"<div class=sidebar>{other()}</div>"]
        elif style == "c":
            before = [f"<div id=header>{other()}</div>"]
            main = f"<div class=post>{rng.choice([article(keep, False) + links(), article(keep, False) + short, short])}</div>"
            after = [f"<div id=comments>{block(text(3, 60))}{other()}</div>", f"<div class=footer>{other()}</div>"]
        else:
            page = rng.choice(["", block(text(1, 2))]) + links() + article(keep, False)
            if rng.random() < 0.3:  # a menu in the midst
                page += links() + block(text(20, 90), keep)
            page += rng.choice(["", block(text(1, 2))]) + links()
            page += rng.choice(["", block(text(2, 7)), block(text(2, 7)) + links()])
            if rng.random() < 0.2:  # nothing but an article, or nothing at all
                page = rng.choice([article(keep, False), block(text(1, 4)), links(), block(text(2, 6)) + links()])
        if style != "p":  # each part beside the article may be missing
            page = "".join([p for p in before if rng.random() < 0.7] + [main] + [p for p in after if rng.random() < 0.7])
        table.append(page)
    return table


@dataclass(frozen=True)
class Leaf:
    keep: bool


@dataclass(frozen=True)
class Split:
    feature: int
    most: float
    low: Split | Leaf
    high: Split | Leaf


def train_tree(rows: np.ndarray, keep: np.ndarray, depth: int = 6) -> Split | Leaf:
    """Binary splits by the least Gini impurity; ties go to the first feature, then the least value."""
    if depth == 0 or keep.all() or not keep.any():
        return Leaf(bool(2 * keep.sum() >= len(keep)))
    best = None
    for k in range(rows.shape[1]):
        values = np.unique(rows[:, k])
        for most in (values[:-1] + values[1:]) / 2:
            low = rows[:, k] <= most
            p, q = keep[low].mean(), keep[~low].mean()
            impurity = low.sum() * p * (1 - p) + (~low).sum() * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, k, float(most))
    if best is None:
        return Leaf(bool(2 * keep.sum() >= len(keep)))
    _, k, most = best
    low = rows[:, k] <= most
    return Split(k, most, train_tree(rows[low], keep[low], depth - 1), train_tree(rows[~low], keep[~low], depth - 1))


def trained_tree(pages: list[str]) -> Split | Leaf:
    """The tree learned from pages whose article blocks carry data-keep."""
    per_page = [text_blocks(p) for p in pages]
    rows = np.vstack([features(b) for b in per_page])
    return train_tree(rows, np.array([b.keep for blocks in per_page for b in blocks]))


@lru_cache(maxsize=1)
def labelled_tree() -> Split | Leaf:
    """The tree learned from the labelled table."""
    return trained_tree(labelled_pages())


def _keeps(tree: Split | Leaf, row: list[float]) -> bool:
    while isinstance(tree, Split):
        tree = tree.low if row[tree.feature] <= tree.most else tree.high
    return tree.keep


def main_text(page: str, tree: Split | Leaf) -> str:
    """The article blocks of a page, joined by an empty line."""
    blocks = text_blocks(page)
    return "\n\n".join(
        b.text for b, row in zip(blocks, features(blocks).tolist(), strict=True) if _keeps(tree, row)
    )


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    labelled: list[str] | None = None,
) -> DataFrame:
    """(id, url, text, n_chars) per page.

    Null and empty pages, and pages without an article block, have an empty text. Pages
    are independent: null or repeated ids and repeated rows pass through, other columns are
    not looked at. ``labelled``: other pages with data-keep to learn from. Broken markup is read as far as it goes; there is no length limit.
    """
    prepare(pages.sparkSession)
    tree = labelled_tree() if labelled is None else trained_tree(labelled)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, tree) for p in texts_of(batch.column(2))]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(map(len, texts), pa.int64())], [id_col, url_col, "text", "n_chars"]
            )

    schema = f"`{id_col}` {type_of(pages, id_col)}, `{url_col}` string, text string, n_chars long"
    return pages.select(id_col, url_col, html_col).mapInArrow(extracted, schema)
