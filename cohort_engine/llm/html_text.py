"""Main text of web pages from flat text blocks and a small decision tree.

A page is scanned once into flat blocks: runs of text between block-level tags, without
scripts, styles, comments and the head.  A block is described by its word count and link
density, those of the blocks before and after it, and where it stands (inside a
boilerplate container, inside an article, a heading, a list item).  A decision tree,
trained here on the small labelled table ``LABELLED``, tells content from boilerplate.

Whether a container is boilerplate is settled after the scan, when its text is known: a
class, id or role counts if a whole token of it says so (``site-footer``, not
``has-header``), never on the page's body nor on a container that holds most of its words;
a form counts if it has fields and little text.  Links under a heading like "References"
are the article's text.  A page on which every block is judged boilerplate keeps its best
ones: unlinked text outside boilerplate, else that of the weakest marks.

Defined results: NULL, empty and markup-only pages give an empty text; broken markup
(unclosed or stray tags, cut-off pages, bare ``<`` and ``&``) is read as browsers do where
it matters for text; repeated rows are extracted alike; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cohort_engine.llm.common import prepare, table

RAW = "script|style|title|textarea|iframe|noembed|noframes|template|noscript|svg"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<[a-zA-Z/!?](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<[a-zA-Z/!?][^>]*+(?:>|\Z)",
    re.S | re.I)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
HINTS = ("class", "id", "role")
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
ANNOTATION = re.compile(r"</(annotation(?:-xml)?)\s*>|</math\b", re.I)      # a formula's source beside it, which is not shown

BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup "
                   "option p pre search section select summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article aside blockquote body button details dialog div dl fieldset figure footer form header main menu nav ol "
                       "search section select table ul".split())
BOILER_TAGS = frozenset("aside button dialog footer form header menu nav search select".split())
SIDE_TAGS = frozenset(("aside", "dialog"))
#: Words of class, id and role values that mark boilerplate (fixed values).
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner masthead nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar aside complementary footer contentinfo header cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay dialog newsletter subscribe subscription signup login search share sharing social "
    "related recommended recommendations widget toolbar pagination pager copyright legal disclaimer skip form".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus discussion replies reply respond responses".split())
ARTICLE_WORDS = frozenset("article post entry story content main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that may stand beside a boilerplate word within one token (fixed values).
BESIDE_WORDS = frozenset(
    "site page main global primary secondary left right top bottom box bar list item items links link container wrapper wrap area block inner outer "
    "section panel content body text title row col column group holder unit slot strip mobile desktop fixed sticky small large new post posts article "
    "articles user policy law bottom upper lower first last".split())
#: Headings whose lists of links are text of the article (fixed values).
REFERENCE_HEADINGS = frozenset(
    "references sources bibliography literature citations notes footnotes literatur quellen einzelnachweise belege références sources bibliographie notes "
    "referencias fuentes bibliografía notas".split())
WORD_SPLIT = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
FIELDS = frozenset("input select textarea button".split())
FORM_WORDS = 60          # a form with more words than this holds text
MOST = 0.5               # share of the page's words from which on a container is not judged by its class

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "boiler", "article", "heading", "item")

#: The labelled table (fixed values): a block's features in the order of FEATURES, then 1 for content, 0 for
#: boilerplate.  Labelled by hand from typical page layouts; densities are shares of linked words.
LABELLED = (
    # an article with heading and paragraphs of any length
    (9, 0, 8, 0, 60, 0, 0, 1, 1, 0, 1), (60, 0, 9, 0, 45, 0, 0, 1, 0, 0, 1), (45, .05, 60, 0, 3, 0, 0, 1, 0, 0, 1),
    (3, 0, 45, .05, 30, 0, 0, 1, 0, 0, 1), (30, .1, 3, 0, 6, 0, 0, 1, 0, 0, 1), (1, 0, 30, .1, 25, 0, 0, 1, 0, 0, 1),
    (2, 0, 11, 0, 9, 0, 0, 1, 1, 0, 1), (6, 0, 6, 0, 4, 0, 0, 1, 0, 0, 1), (8, .2, 40, 0, 9, 1, 0, 1, 0, 0, 1),
    (14, 0, 20, 0, 12, 0, 0, 1, 0, 1, 1), (5, 0, 14, 0, 7, 0, 0, 1, 0, 1, 1), (4, 0, 9, 1, 50, 0, 0, 1, 1, 0, 1),
    (120, .02, 4, 0, 200, 0, 0, 1, 0, 0, 1), (200, .15, 120, 0, 10, .5, 0, 1, 0, 0, 1), (10, .5, 200, .15, 15, 0, 0, 1, 0, 0, 1),
    (35, .3, 10, 0, 12, 0, 0, 1, 0, 0, 1), (7, 0, 35, 0, 11, .1, 0, 1, 0, 0, 1), (1, 0, 2, 0, 1, 0, 0, 1, 0, 0, 1),
    # short titles and first lines
    (2, 0, 1, 1, 5, 0, 0, 1, 1, 0, 1), (5, 0, 13, 0, 5, 0, 0, 1, 1, 0, 1), (4, 0, 11, 0, 4, 0, 0, 1, 1, 0, 1), (3, 0, 0, 0, 2, 0, 0, 1, 1, 0, 1),
    (1, 0, 5, 0, 9, 0, 0, 1, 1, 0, 1), (5, 0, 5, 0, 25, 0, 0, 1, 0, 0, 1), (4, 0, 4, 0, 46, 0, 0, 1, 0, 0, 1), (3, 0, 5, 0, 12, 0, 0, 1, 1, 0, 1),
    (4, 0, 13, 0, 4, 0, 0, 1, 1, 0, 1), (2, 0, 2, 0, 8, 0, 0, 1, 0, 0, 1), (7, 0, 24, 0, 90, 0, 0, 1, 1, 0, 1), (4, 0, 4, 0, 0, 0, 0, 1, 0, 0, 1),
    # after a short heading and before links or the page's end, and text with many links
    (60, 0, 3, 0, 8, 1, 0, 1, 0, 0, 1), (150, .02, 2, 0, 4, 1, 0, 1, 0, 0, 1), (40, 0, 4, 0, 30, .4, 0, 1, 0, 0, 1), (6, 0, 2, 0, 1, 1, 0, 1, 0, 0, 1),
    (80, 0, 3, 0, 0, 0, 0, 1, 0, 0, 1), (2, 0, 2, 0, 3, 1, 0, 1, 0, 0, 1), (3, 0, 1, 0, 2, .5, 0, 1, 0, 1, 1), (60, 0, 3, 0, 8, 1, 0, 0, 0, 0, 1),
    (150, .02, 2, 0, 4, 1, 0, 0, 0, 0, 1), (40, 0, 4, 0, 30, .4, 0, 0, 0, 0, 1), (30, 0, 1, 1, 2, 1, 0, 0, 0, 0, 1), (26, .1, 2, 0, 3, 1, 0, 0, 0, 1, 1),
    (4, 0, 6, 1, 2, 1, 0, 1, 0, 0, 1), (1, 0, 1, 1, 1, 1, 0, 1, 0, 0, 1), (9, .3, 2, 1, 3, 1, 0, 1, 0, 1, 1), (12, 0, 3, .8, 0, 0, 0, 1, 0, 0, 1),
    (5, 0, 17, 0, 26, 0, 0, 0, 1, 0, 1), (4, 0, 12, .1, 30, 0, 0, 0, 1, 0, 1), (2, 0, 25, 0, 60, 0, 0, 0, 1, 0, 1),
    (70, .65, 40, 0, 60, .1, 0, 1, 0, 0, 1), (120, .75, 3, 0, 5, 1, 0, 1, 0, 0, 1), (50, .6, 30, .2, 0, 0, 0, 1, 0, 0, 1),
    (3, 0, 40, 0, 2, 1, 0, 1, 0, 0, 1), (1, 0, 12, 0, 1, 1, 0, 1, 0, 0, 1), (5, 0, 33, 0, 6, .9, 0, 1, 0, 0, 1), (2, 0, 7, 1, 4, 1, 0, 1, 1, 0, 1),
    (50, 1, 60, 0, 40, 0, 0, 1, 0, 0, 1), (80, 1, 5, 0, 3, 1, 0, 1, 0, 0, 1), (35, 1, 30, .1, 0, 0, 0, 1, 0, 0, 1),
    # links in an article that are not its text
    (4, 1, 60, 0, 5, 1, 0, 1, 0, 1, 0), (5, 1, 4, 1, 3, 1, 0, 1, 0, 1, 0), (3, 1, 5, 1, 11, 0, 0, 1, 0, 1, 0),
    (6, .95, 30, 0, 8, 1, 0, 1, 0, 0, 0), (9, 1, 80, 0, 40, 0, 0, 1, 0, 0, 0), (2, 1, 9, 0, 50, 0, 0, 1, 0, 0, 0),
    # boilerplate containers, with short and with long texts, beside and inside the article
    (1, 1, 0, 0, 1, 1, 1, 0, 0, 1, 0), (1, 1, 1, 1, 1, 1, 1, 0, 0, 1, 0), (8, 0, 1, 1, 9, 0, 1, 0, 0, 0, 0),
    (12, 0, 30, 0, 0, 0, 1, 0, 0, 0, 0), (40, 0, 12, 0, 60, 0, 1, 0, 0, 0, 0), (60, .1, 40, 0, 35, 0, 1, 1, 0, 0, 0),
    (35, 0, 60, .1, 20, 0, 1, 1, 0, 0, 0), (5, 0, 20, 0, 18, 0, 1, 0, 1, 0, 0), (100, 0, 5, 0, 90, .1, 1, 0, 0, 0, 0),
    (18, .2, 5, 0, 6, 1, 1, 1, 0, 1, 0), (25, 0, 45, 0, 3, 0, 1, 0, 0, 0, 0), (2, 0, 25, 0, 2, 0, 1, 1, 0, 0, 0),
    (3, 0, 70, 0, 9, 0, 1, 1, 1, 0, 0), (150, 0, 3, 0, 0, 0, 1, 1, 0, 0, 0), (9, .4, 20, 0, 1, 1, 1, 0, 0, 0, 0),
    # pages without an article element: long plain text and what stands between
    (70, .03, 8, 0, 55, 0, 0, 0, 0, 0, 1), (55, 0, 70, .03, 30, .1, 0, 0, 0, 0, 1), (30, .1, 55, 0, 22, 0, 0, 0, 0, 0, 1),
    (22, 0, 30, .1, 80, 0, 0, 0, 0, 0, 1), (14, 0, 60, 0, 50, 0, 0, 0, 0, 0, 1), (9, 0, 50, 0, 45, 0, 0, 0, 0, 0, 1),
    (8, 0, 3, 1, 70, 0, 0, 0, 1, 0, 1), (5, 0, 60, 0, 40, 0, 0, 0, 1, 0, 1), (12, 0, 40, 0, 33, 0, 0, 0, 0, 1, 1),
    (18, 0, 35, 0, 4, 1, 0, 0, 0, 0, 1), (26, .2, 6, 0, 18, 0, 0, 0, 0, 0, 1), (110, 0, 26, 0, 2, 1, 0, 0, 0, 0, 1),
    (30, 0, 40, 0, 0, 0, 0, 0, 0, 0, 1), (12, 0, 50, 0, 1, 0, 0, 0, 0, 0, 1), (25, 0, 9, 0, 2, 0, 0, 0, 0, 0, 1), (60, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1),
    # and their menus, lines and lists of links
    (1, 1, 0, 0, 2, 1, 0, 0, 0, 1, 0), (2, 1, 1, 1, 1, 1, 0, 0, 0, 1, 0), (4, 1, 2, 1, 8, 0, 0, 0, 0, 1, 0),
    (3, 0, 2, 1, 2, 1, 0, 0, 0, 0, 0), (6, .8, 50, 0, 7, 1, 0, 0, 0, 0, 0), (7, 1, 6, .8, 5, .6, 0, 0, 0, 0, 0),
    (5, .6, 7, 1, 0, 0, 0, 0, 0, 0, 0), (4, 0, 5, 1, 3, 1, 0, 0, 1, 0, 0), (12, .9, 3, 1, 15, .9, 0, 0, 0, 0, 0),
    (15, .9, 12, .9, 10, 1, 0, 0, 0, 1, 0), (2, 0, 3, 0, 2, 0, 0, 0, 0, 0, 0), (3, 0, 2, 0, 4, .5, 0, 0, 0, 0, 0),
)
TREE_DEPTH = 7


@dataclass
class Tree:
    """A binary decision tree: threshold nodes, or a class at a leaf."""
    feature: int = -1
    threshold: float = 0.0
    label: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(x), self.label)
        below = x[:, self.feature] <= self.threshold
        out = np.empty(len(x), int)
        out[below] = self.low.predict(x[below])
        out[~below] = self.high.predict(x[~below])
        return out


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = TREE_DEPTH) -> Tree:
    """CART with Gini impurity; the first best of features and thresholds in order."""
    if depth == 0 or len(set(y)) < 2:
        return Tree(label=int(2 * y.sum() >= len(y)))
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = y[x[:, f] <= t]
            high = y[x[:, f] > t]
            impurity = sum(len(s) * 2 * s.mean() * (1 - s.mean()) for s in (low, high))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, t)
    if best is None:
        return Tree(label=int(2 * y.sum() >= len(y)))
    _, f, t = best
    below = x[:, f] <= t
    return Tree(f, float(t), 0, train_tree(x[below], y[below], depth - 1), train_tree(x[~below], y[~below], depth - 1))


def content_tree(rows=LABELLED) -> Tree:
    data = np.array(rows, float)
    return train_tree(data[:, :-1], data[:, -1].astype(int))


@dataclass
class Block:
    text: str = ""
    words: int = 0
    linked: int = 0
    flags: tuple[int, int, int, int] = (0, 0, 0, 0)
    strong: bool = False                         # hidden, beside the text, or a reader's comment
    parts: list[tuple[str, bool]] = field(default_factory=list)

    def close(self) -> bool:
        """Decode and measure; False for a block without text."""
        raw = "".join(p for p, _ in self.parts)
        self.text = " ".join(html.unescape(raw).split())
        self.words = len(self.text.split(" ")) if self.text else 0
        self.linked = min(self.words, sum(len(html.unescape(p).split()) for p, link in self.parts if link))
        return bool(self.text)


def says(value: str, words: frozenset) -> bool:
    """Whether a token of a class, id or role consists of ``words`` and words that stand beside them."""
    for token in value.split():
        parts = [w for w in WORD_SPLIT.split(CAMEL.sub("-", token).lower()) if w]
        if any(w in words for w in parts) and all(w in words or w in BESIDE_WORDS for w in parts):
            return True
    return False


def hint_of(tag: str) -> tuple[bool, bool, bool, bool]:
    """Whether class, id and role say boilerplate, comments, article; whether the element is not shown."""
    values: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(tag, NAME.match(tag).end()):
        values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    own = " ".join(values[k] for k in HINTS if k in values)
    words = set(WORD_SPLIT.split(CAMEL.sub("-", own).lower()))
    hidden = "hidden" in values or values.get("aria-hidden", "").strip().lower() == "true" or bool(NOT_SHOWN.search(values.get("style", "")))
    return says(own, BOILER_WORDS), says(own, COMMENT_WORDS), bool(words & ARTICLE_WORDS), hidden


@dataclass
class Container:
    """An element that holds blocks, with what its tag says and, once the page is read, how much it holds."""
    name: str
    parent: int
    boiler: bool = False
    comments: bool = False
    article: bool = False
    hidden: bool = False
    words: int = 0
    fields: int = 0

    def settle(self, mark: int, article: int, total: int) -> tuple[int, int]:
        """Boilerplate (2: cannot hold an article) and article inside, given those outside."""
        most = self.words > MOST * total
        if self.hidden or self.comments or self.name in SIDE_TAGS:
            return 2, article
        if self.name == "form":
            says_boiler = self.fields > 0 and self.words <= FORM_WORDS
        else:
            says_boiler = self.name in BOILER_TAGS and not (self.name == "header" and article) or self.boiler and not most and not self.article
        if self.name in ("article", "main") and mark < 2:
            return 0, 1
        if says_boiler:
            return max(mark, 1), article
        return mark, int(article or self.article and not mark and self.name in ("div", "section"))


def text_blocks(page: str) -> list[Block]:
    """The page's flat blocks, in order."""
    out: list[Block] = []
    places: list[tuple[int, int, int, bool, bool]] = []      # per block: container, heading, item, own hint, not shown
    containers = [Container("", -1)]
    stack: list[int] = [0]                                   # open containers
    heading = item = link = in_head = in_math = 0
    own = unseen = False
    block = Block()

    def finish() -> None:
        nonlocal block
        if block.parts:
            if block.close():
                out.append(block)
                places.append((stack[-1], heading, item, own, unseen))
            block = Block()

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        upto = m.start() if m else end
        if upto > at and not in_head:
            block.parts.append((page[at:upto], link > 0))
        if not m:
            break
        at, tag = m.end(), m[0]
        name_m = NAME.match(tag)
        if not name_m:
            continue
        name, closing = name_m[1].lower(), tag[1] == "/"
        if name in FIELDS and not closing:
            containers[stack[-1]].fields += 1
        if not closing and name in RAW_NAMES:    # raw text ends at its own end tag, or with the page
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name == "math":
            in_math = int(not closing and not tag.endswith("/>"))
            continue
        if name == "annotation" and in_math and not closing and not tag.endswith("/>"):
            close = ANNOTATION.search(page, at)
            at = (close.end() if close[1] else close.start()) if close else at
            continue
        if name == "a":
            link = 0 if closing else 1
            continue
        if name == "br":
            if not in_head:
                block.parts.append((" ", False))
            continue
        if name not in BLOCKS:
            continue
        finish()
        own = unseen = False
        heading = 0
        if name == "head":
            in_head = 0 if closing else 1
            continue
        if name == "body" or (in_head and name in CONTAINERS):
            in_head = 0
        item = int(name == "li" and not closing) if name in ("li", "ul", "ol", "p") else item
        if closing:
            link = 0
            for i in range(len(stack) - 1, 0, -1):
                if containers[stack[i]].name == name:
                    del stack[i:]
                    break
            continue
        heading = int(name in HEADINGS)
        hints = hint_of(tag) if len(tag) > len(name) + 2 and name not in ("body", "html") else (False,) * 4
        if name in CONTAINERS:
            link = 0
            containers.append(Container(name, stack[-1], *hints))
            stack.append(len(containers) - 1)
        else:
            own, unseen = hints[0] or hints[1], hints[3]
    finish()
    return judged(out, places, containers)


def judged(blocks: list[Block], places: list[tuple], containers: list[Container]) -> list[Block]:
    """The blocks with their flags, now that it is known what each container holds."""
    for b, place in zip(blocks, places):
        containers[place[0]].words += b.words
    for c in reversed(containers[1:]):
        containers[c.parent].words += c.words
        containers[c.parent].fields += c.fields
    inside = [(0, 0)]
    for c in containers[1:]:                     # parents come first
        inside.append(c.settle(*inside[c.parent], containers[0].words))
    cited = False
    for b, (at, heading, item, own, unseen) in zip(blocks, places):
        boiler, article = inside[at]
        if heading:
            cited = bool(article) and b.text.lower().strip(" :") in REFERENCE_HEADINGS
        elif cited and article:
            b.linked = 0                         # the links are what the list says
        b.flags = (int(bool(boiler or unseen or own and not article)), int(bool(article)), heading, item)
        b.strong = boiler > 1 or unseen
    return blocks


RAW_NAMES = frozenset(RAW.split("|"))


def block_features(blocks: list[Block]) -> np.ndarray:
    n = len(blocks)
    words = np.array([b.words for b in blocks], float)
    links = np.array([b.linked for b in blocks], float) / np.maximum(words, 1)
    x = np.zeros((n, len(FEATURES)))
    x[:, 0], x[:, 1] = words, links
    x[1:, 2], x[1:, 3] = words[:-1], links[:-1]
    x[:-1, 4], x[:-1, 5] = words[1:], links[1:]
    x[:, 6:] = [b.flags for b in blocks]
    return x


def main_text(page: str | None, tree: Tree) -> str:
    blocks = text_blocks(page or "")
    if not blocks:
        return ""
    keep = tree.predict(block_features(blocks))
    if not keep.any():
        plain = [b.linked < b.words / 2 and not b.strong for b in blocks]
        clean = [p and not b.flags[0] for p, b in zip(plain, blocks)]
        keep = clean if any(clean) else [p and b.words >= 10 for p, b in zip(plain, blocks)]
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    tree = content_tree()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [main_text(p, tree) for p in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string, n_chars long")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return extract_text(table(spark, sf_dir, "pages"))
