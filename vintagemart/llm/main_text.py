"""The main text of web pages.

A page is read once into flat text blocks: the text between two tags that are not inline.  A
block has its number of words, its link density (the share of its words inside links) and
the same of the blocks before and after it; besides, whether the markup around it names
something that is not the article (a menu, a form, an advert), whether it stands in an element
that names the article, whether the page has such an element, and whether it is a heading.
A decision tree over these decides which blocks are main text.  It is trained on the
blocks of a small labelled table, ``samples.PAGES``, in which the elements
that hold main text carry a mark; another table may be given.

Pages are independent of each other, so the job is one pass without a shuffle.

Defined results: a null or empty page has an empty text, and so has a page none of whose blocks is
main text.  Character references are decoded as browsers do, each run of white space in a block
(line breaks made by markup too) is one blank, and blocks are joined in page order by one line
end.  Markup that is cut off or not closed is read as far as it goes.  Every row is
judged by itself, so repeated rows and very long pages need no care, and an empty table gives none.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import samples
from .text import blocks

# Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)

# Elements whose content is never text, and elements without content.
SKIPPED = "script style title noscript template iframe object svg canvas audio video"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# Elements, roles and words of class names and ids that name something other than the article.
OTHER_ELEMENTS = frozenset("nav header footer aside form dialog menu button select textarea option fieldset".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " copyright disclaimer discussion disqus feedback footer form gdpr header login masthead menu modal nav navbar navigation newsletter"
    " notice notices notification overlay pager pagination popup promo promotion recommended related replies reply respond"
    " search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

# The same for the article.
ARTICLE_ELEMENTS = frozenset(("article", "main"))
ARTICLE_NAMES = frozenset("article articlebody body content entry main post story text".split())

HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

# Elements that end an open one of the same group, and those that keep it open.
_CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "option": ("option", {"select"})}
_CLOSES |= {"tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"})}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({SKIPPED.replace(' ', '|')})(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"""|<(/?)([a-z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>"""
    r"|</?[a-z!?][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
# A class name that tells what the page has elsewhere.
_ELSEWHERE = re.compile(r"(?:has|no|with|without|is|js)[-_]", re.I)

FEATURES = [
    "words", "words_before", "words_after", "link_density", "link_density_before", "link_density_after",
    "named_other", "named_article", "page_has_article", "heading",
]


class Block(NamedTuple):
    """One block: its text, words, words in links, and what the markup around it says."""

    text: str
    words: int
    linked: int
    other: bool
    article: bool
    heading: bool
    marked: bool


class _Open(NamedTuple):
    """An open element, with what holds for all inside it."""

    name: str
    link: bool
    other: bool
    article: bool
    heading: bool
    marked: bool


_ROOT = _Open("", False, False, False, False, False)


def _opened(name: str, attributes: str, around: _Open) -> _Open:
    link, other, article = around.link or name == "a", around.other, around.article
    marked = around.marked
    if name in ARTICLE_ELEMENTS:
        article = True
    # A header inside an article is the article's own.
    elif name in OTHER_ELEMENTS and not (name == "header" and article):
        other = True
    if attributes and not attributes.isspace() and name not in ("html", "body"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id", "itemprop"):
                for one in value.split():
                    if _ELSEWHERE.match(one):
                        continue
                    names = {n.lower() for n in _NAME.findall(one)}
                    own = not names.isdisjoint(ARTICLE_NAMES)
                    if not names.isdisjoint(OTHER_NAMES) and not (names & OTHER_NAMES == {"header"} and (own or article)):
                        other = True
                    elif own:
                        article = True
            elif key == "role":
                other, article = other or value.lower() in OTHER_ROLES, article or value.lower() in ("main", "article")
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                other = True
            elif key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                other = True
            elif key == samples.MARK:
                marked = True
    return _Open(name, link, other, article, around.heading or name in HEADINGS, marked)


def _close(stack: list[_Open], names: str, keepers: frozenset | set = frozenset()) -> None:
    """Close the innermost open element of these names, and all inside it, unless a keeper stands in between."""
    wanted = names.split()
    for at in range(len(stack) - 1, 0, -1):
        if stack[at].name in wanted:
            del stack[at:]
            return
        if stack[at].name in keepers:
            return


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order."""
    found: list[Block] = []
    if not page:
        return found
    stack = [_ROOT]
    parts: list[str] = []
    linked = 0
    at_first = _ROOT

    def text(start: int, stop: int) -> None:
        nonlocal linked, at_first
        if stop > start:
            piece = html.unescape(page[start:stop])
            if not piece.isspace():
                if not any(p != " " for p in parts):
                    at_first = stack[-1]
                if stack[-1].link:
                    linked += len(piece.split())
            parts.append(piece)

    def end_block() -> None:
        nonlocal linked
        words = "".join(parts).split()
        if words:
            found.append(Block(" ".join(words), len(words), min(linked, len(words)), *at_first[2:]))
        parts.clear()
        linked = 0

    at = 0
    for token in _TOKEN.finditer(page):
        text(at, token.start())
        at = token.end()
        name = token[3]
        if name is None:
            continue
        name, closing = name.lower(), bool(token[2])
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            end_block()
        if closing:
            _close(stack, name)
        else:
            if name not in INLINE:
                # A paragraph ends where another block begins.
                if stack[-1].name == "p" or any(e.name == "p" for e in stack[1:]):
                    _close(stack, "p", {"table", "button", "object"})
                if name in _CLOSES:
                    _close(stack, *_CLOSES[name])
            if name not in VOID:
                stack.append(_opened(name, token[4], stack[-1]))
    text(at, len(page))
    end_block()
    return found


def features_of(found: list[Block]) -> np.ndarray:
    """One row per block, columns as in ``FEATURES``."""
    out = np.zeros((len(found), len(FEATURES)))
    if not found:
        return out
    words = np.array([b.words for b in found], dtype=float)
    density = np.array([b.linked for b in found], dtype=float) / words
    for column, values in ((0, words), (3, density)):
        out[:, column] = values
        out[1:, column + 1] = values[:-1]
        out[:-1, column + 2] = values[1:]
    out[:, 6] = [b.other for b in found]
    out[:, 7] = [b.article for b in found]
    out[:, 8] = any(b.article and not b.other for b in found)
    out[:, 9] = [b.heading for b in found]
    return out


class Tree(NamedTuple):
    """Nodes of a decision tree; a node without a feature (-1) is a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    main: np.ndarray

    def decide(self, rows: np.ndarray) -> np.ndarray:
        """Whether each row is main text."""
        node = np.zeros(len(rows), dtype=np.int64)
        while (inner := np.flatnonzero(self.feature[node] >= 0)).size:
            here = node[inner]
            low = rows[inner, self.feature[here]] <= self.threshold[here]
            node[inner] = np.where(low, self.left[here], self.right[here])
        return self.main[node]


def labelled_blocks(spark: SparkSession, pages: list[str] | None = None) -> DataFrame:
    """Blocks of pages whose main text is marked: (features, label)."""
    rows = []
    for page in samples.PAGES if pages is None else pages:
        found = blocks_of(page)
        rows += [(Vectors.dense(f), float(b.marked)) for f, b in zip(features_of(found).tolist(), found)]
    return spark.createDataFrame(rows, ["features", "label"])


def fit(labelled: DataFrame, *, depth: int = 8) -> Tree:
    """A decision tree over the labelled blocks."""
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=128, minInstancesPerNode=1, seed=7).fit(labelled)
    nodes: list[list] = []

    def add(node) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, node.prediction() > 0.5])
        if node.subtreeDepth() > 0:
            nodes[at][:2] = node.split().featureIndex(), node.split().threshold()
            nodes[at][2:4] = add(node.leftChild()), add(node.rightChild())
        return at

    add(model._java_obj.rootNode())
    return Tree(*[np.array(column) for column in zip(*nodes)])


def extract(pages: DataFrame, tree: Tree, *, html_column: str = "html", columns: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The named columns with the main text of each page and its length: (..., text, n_chars)."""
    shared = pages.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, htmls in blocks(batches, "html"):
            found = [blocks_of(h) for h in htmls]
            flat = [b.text for page in found for b in page]
            main = shared.value.decide(np.concatenate([features_of(page) for page in found]))
            texts, at = [], 0
            for page in found:
                texts.append("\n".join(flat[i] for i in range(at, at + len(page)) if main[i]))
                at += len(page)
            out = [*rows.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(out, names=[*rows.schema.names[:-1], "text", "n_chars"])

    wanted = pages.select(*columns, F.col(html_column).alias("html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields[:-1])
    return wanted.mapInArrow(run, f"{schema}, text string, n_chars long")
