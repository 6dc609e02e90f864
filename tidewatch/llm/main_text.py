"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks of text at the borders of block elements.  A block is described by its word count and
link density, those of the block before and after it, and by what encloses it: elements and names that mark page
furniture, an article or main element, a heading.  A CART tree fitted on the labelled pages of
:data:`LABELLED` tells content from the rest; a page's text is its content blocks in order.

Pages are read row by row inside Spark's tasks; the fitted tree has some ten nodes and is sent with the function.

Edge cases: null and empty pages, and pages without content blocks, give an empty text; cut-off tags, comments and scripts
end with the page; a character reference without its end is read as browsers do; rows are independent, so repeated
rows and null ids give one result each; other columns are kept, those named like a result column are replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: HTML elements by their part in the layout
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table tbody td tfoot th thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: the text of these is not markup
RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
#: elements that are never part of an article's text
FURNITURE = frozenset(
    "head title script style template noscript iframe object svg math canvas audio video map xmp noembed noframes"
    " nav menu footer aside dialog form button select option optgroup textarea input label fieldset datalist search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: words in class, id and role that mark page furniture
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle banner promo promotion sponsor sponsored sponsors cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar side rail"
    " menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead toolbar topbar"
    " comment comments commentlist disqus reply replies respond discussion share sharing social related recommended recommendations"
    " trending widget widgets login signin search legal copyright disclaimer skip hidden complementary contentinfo".split())
#: words that keep a name from marking furniture on their own, unless it holds one of ALWAYS
CONTENT_WORDS = frozenset("article content entry post story main body text page layout has with no without wrapper container".split())
ALWAYS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored cookie cookies comment comments commentlist disqus"
    " replies respond newsletter sidebar related share sharing social nav navigation menu footer".split())
ARTICLE_WORDS = frozenset("articlebody articletext entrycontent postcontent postbody articlecontent storybody maincontent".split())

#: what ends the search for an open paragraph or inline element
_OUTER = BLOCK - {"p"}

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))"""  # comment
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)(?:>|\Z)"""
    r"""|<[!?/][^>]*+(?:>|\Z)"""  # declaration or stray end
    r"""|(?P<text>[^<]++|<)""", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])|</{name}\\Z", re.I) for name in RAW}


@dataclass
class Block:
    words: int
    linked: int
    #: the page's furniture encloses it
    furniture: bool
    #: inside an article or main element
    article: bool
    heading: bool
    text: str

    @property
    def link_density(self) -> float:
        return self.linked / self.words


def _marks(attrs: str) -> tuple[bool, bool]:
    """(marks furniture, marks an article) by class, id, role and visibility."""
    if "=" not in attrs and "hidden" not in attrs.lower():
        return False, False
    furniture = article = False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            furniture = True
        elif name == "aria-hidden":
            furniture |= value.lower() == "true"
        elif name == "role":
            words = value.lower().split()
            article |= "main" in words or "article" in words
            furniture |= any(w in FURNITURE_WORDS or w in ("alertdialog", "status", "form") for w in words)
        elif name in ("class", "id", "itemprop"):
            for one in html.unescape(value).split():
                words = {w.lower() for w in _WORD.findall(one)}
                article |= "".join(w.lower() for w in _WORD.findall(one)) in ARTICLE_WORDS
                hits = words & FURNITURE_WORDS
                furniture |= bool(hits) and (bool(hits & ALWAYS) and not words & {"has", "with", "no", "without"}
                                             or not words & CONTENT_WORDS)
    return furniture, article and not furniture


def blocks(page: str | None) -> list[Block]:
    """Flat text blocks of a page, in order."""
    page = page or ""
    out: list[Block] = []
    parts: list[str] = []
    #: (name, furniture, article, cuts) of the open elements
    stack: list[tuple[str, bool, bool, bool]] = []
    standing: Counter[str] = Counter()
    furniture = article = links = headings = 0
    linked: list[str] = []

    def cut() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                inside = len(html.unescape("".join(linked)).split()) if linked else 0
                n = text.count(" ") + 1
                out.append(Block(n, min(n, inside), furniture > 0, article > 0, headings > 0, text))
            parts, linked = [], []

    def close(depth: int) -> None:
        nonlocal furniture, article, links, headings
        while len(stack) > depth:
            name, bad, good, cuts = stack.pop()
            standing[name] -= 1
            if cuts:
                cut()
            furniture -= bad
            article -= good
            links -= name == "a"
            headings -= name in HEADINGS

    def opened(names: frozenset | set, until: frozenset | set = frozenset()) -> int:
        """Depth of the innermost open element of these names, -1 if there is none above one of ``until``."""
        if not any(standing[name] for name in names):
            return -1
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in names:
                return depth
            if stack[depth][0] in until:
                return -1
        return -1

    at, match = 0, _TOKEN.match
    while at < len(page):
        token = match(page, at)
        at = token.end()
        text = token["text"]
        if text is not None:
            parts.append(text)
            if links:
                linked.append(text)
            continue
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if name == "br" or name == "p" and opened({"p"}) < 0:
                parts.append(" ")
            elif (depth := opened({name}, frozenset() if name in BLOCK else _OUTER)) >= 0:
                close(depth)
            if name in BLOCK:
                cut()
            continue
        if name in RAW:
            # its text is no markup, and none of these is part of an article
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
            if name not in ("script", "style"):
                cut()
        if name in VOID:
            if name == "br":
                parts.append(" ")
                if links:
                    linked.append(" ")
            elif name == "hr":
                close(depth) if (depth := opened({"p"}, _OUTER)) >= 0 else cut()
            continue
        if name in BLOCK:
            if (depth := opened({"p"}, _OUTER)) >= 0:
                close(depth)
            if name == "li" and (depth := opened({"li"}, {"ul", "ol", "menu"})) >= 0:
                close(depth)
            elif name in ("dt", "dd") and (depth := opened({"dt", "dd"}, {"dl"})) >= 0:
                close(depth)
            elif name in ("td", "th") and (depth := opened({"td", "th"}, {"tr", "table"})) >= 0:
                close(depth)
            elif name == "tr" and (depth := opened({"tr"}, {"table"})) >= 0:
                close(depth)
            cut()
        elif name == "a" and (depth := opened({"a"}, BLOCK)) >= 0:
            close(depth)
        bad, good = _marks(token["attrs"]) if token["attrs"] else (False, False)
        if name in ("html", "body"):
            bad = False
        bad |= name in FURNITURE or name == "header" and not article
        good |= name in ("article", "main")
        cuts = name in BLOCK or bad
        if cuts:
            cut()
        if not (cuts or good or name == "a"):
            continue  # other inline elements say nothing of their text
        stack.append((name, bad, good, cuts))
        standing[name] += 1
        furniture += bad
        article += good
        links += name == "a"
        headings += name in HEADINGS
    cut()
    return out


FEATURES = ("furniture", "place", "heading", "words", "link density", "words before", "link density before", "words after",
            "link density after")


def features(found: list[Block]) -> np.ndarray:
    """One row per block; ``place`` is 1 in an article, -1 outside of the page's articles, 0 on pages without one."""
    some = any(b.article for b in found)
    size = np.array([(0, 0.0), *((b.words, b.link_density) for b in found), (0, 0.0)], dtype=float)
    own = np.array([(b.furniture, 1 if b.article else -some, b.heading) for b in found], dtype=float).reshape(-1, 3)
    return np.hstack([own, size[1:-1], size[:-2], size[2:]])


@dataclass
class Tree:
    """A binary decision tree: (feature, limit, branch at most the limit, branch above it), or a leaf's class."""

    nodes: list[tuple] = field(default_factory=list)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), dtype=bool)

        def walk(node: int, here: np.ndarray) -> None:
            if not len(here):
                return
            if len(self.nodes[node]) == 1:
                out[here] = self.nodes[node][0]
                return
            column, limit, low, high = self.nodes[node]
            left = rows[here, column] <= limit
            walk(low, here[left])
            walk(high, here[~left])

        if self.nodes:
            walk(0, np.arange(len(rows)))
        return out


def fit(rows: np.ndarray, labels: np.ndarray, deepest: int = 8, least: int = 1) -> Tree:
    """CART by Gini impurity; ties go to the earlier feature and the lower limit."""
    tree = Tree()

    def impurity(y: np.ndarray) -> float:
        p = y.mean()
        return 2 * p * (1 - p) * len(y)

    def grow(here: np.ndarray, depth: int) -> int:
        y, place = labels[here], len(tree.nodes)
        tree.nodes.append((bool(2 * y.sum() > len(y)),))
        best = (impurity(y) - 1e-9, None, None)
        if depth < deepest and 0 < y.sum() < len(y):
            for column in range(rows.shape[1]):
                values = np.unique(rows[here, column])
                for limit in (values[1:] + values[:-1]) / 2:
                    low = rows[here, column] <= limit
                    if least <= low.sum() <= len(y) - least:
                        cost = impurity(y[low]) + impurity(y[~low])
                        if cost < best[0] - 1e-9:
                            best = (cost, column, limit)
        if best[1] is not None:
            low = rows[here, best[1]] <= best[2]
            left = grow(here[low], depth + 1)
            right = grow(here[~low], depth + 1)
            tree.nodes[place] = (best[1], float(best[2]), left, right)
        return place

    if len(rows):
        grow(np.arange(len(rows)), 0)
    return tree


def labelled_rows(pages: list[list[tuple[int, str]]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of pages given as pieces of markup; the blocks that end in a piece carry its label."""
    rows, labels = [], []
    for pieces in pages:
        found = blocks("".join(markup for _, markup in pieces))
        ends, seen = [], ""
        for label, markup in pieces:
            seen += markup
            ends.append((len(blocks(seen)), label))
        rows.append(features(found))
        labels += [next(label for end, label in ends if i < end) for i in range(len(found))]
    return np.vstack(rows), np.array(labels, dtype=bool)


def _prose(n: int) -> str:
    return " ".join(["word"] * n)


def _links(*sizes: int) -> str:
    return "".join(f"<li><a href='/x'>{_prose(n)}</a></li>" for n in sizes)


#: the labelled table: pages as (1 content, 0 other, markup), in reading order
LABELLED: list[list[tuple[int, str]]] = [
    [(0, f"<header><a href='/'>{_prose(2)}</a></header><nav><ul>{_links(1, 2, 1)}</ul></nav>"),
     (1, f"<article><h1>{_prose(6)}</h1><p>{_prose(60)}</p><p>{_prose(3)}</p><p>{_prose(1)}</p>"),
     (1, f"<ul>{_links(4, 5)}</ul><p>{_prose(30)}</p></article>"), (0, f"<footer>{_prose(30)}</footer>")],
    [(0, f"<div class='ad'>{_prose(25)}</div>"), (1, f"<article><h1>{_prose(2)}</h1><p>{_prose(4)}</p></article>"),
     (0, f"<div class='comments'><p>{_prose(40)}</p><p>{_prose(15)}</p></div>")],
    [(0, f"<div>{_prose(20)}</div><div>{_prose(4)}</div>"), (1, f"<main><p>{_prose(2)}</p><p>{_prose(90)}</p></main>"),
     (0, f"<div>{_prose(25)}</div><p>{_prose(40)}</p>")],
    [(1, f"<article><p>{_prose(1)}</p>"), (0, f"<aside><p>{_prose(50)}</p><ul>{_links(3, 3)}</ul></aside>"),
     (1, f"<p>{_prose(12)}</p><h2>{_prose(3)}</h2><p>{_prose(8)}</p>"), (0, f"<form><p>{_prose(18)}</p></form>"), (1, f"<p>{_prose(2)}</p></article>")],
    [(0, f"<nav><ul>{_links(1, 3, 2)}</ul></nav>"), (1, f"<article><h1>{_prose(1)}</h1></article>")],
    [(0, f"<nav><ul>{_links(1, 3, 2)}</ul></nav>"), (1, f"<article><p>{_prose(5)}</p></article>")],
    [(0, f"<nav><ul>{_links(2, 2)}</ul></nav>"), (1, f"<article><p><a href='/'>{_prose(4)}</a></p><p>{_prose(1)}</p></article>"), (0, f"<footer>{_prose(1)}</footer>")],
    [(1, f"<main><p>{_prose(3)}</p><ul>{_links(2, 7, 1)}</ul><p>{_prose(2)}</p></main>"), (0, f"<footer>{_prose(8)} <a href='/'>{_prose(2)}</a></footer>")],
    [(1, f"<article><p>{_prose(200)}</p><p>{_prose(2)}</p></article>"), (0, f"<aside><p>{_prose(100)}</p></aside><div>{_prose(1)}</div>")],
    [(0, f"<div class='notice'>{_prose(60)}</div><aside>{_prose(70)}</aside>"), (1, f"<main><h1>{_prose(3)}</h1><p>{_prose(10)}</p></main>"),
     (0, f"<section id='comments'><h2>{_prose(2)}</h2><p>{_prose(70)}</p><p>{_prose(3)}</p><p>{_prose(35)}</p></section>")],
    [(0, f"<div class='sponsor'>{_prose(1)}</div>"), (1, f"<article><p>{_prose(1)}</p></article>"), (0, f"<div class='sponsor'>{_prose(1)}</div>")],
    # pages without an article element
    [(0, f"<div>{_prose(2)}</div><ul>{_links(1, 1, 2, 3)}</ul>"), (1, f"<h1>{_prose(7)}</h1><p>{_prose(45)}</p><p>{_prose(80)}</p><p>{_prose(25)}</p>"),
     (0, f"<ul>{_links(4, 6, 5)}</ul><div>{_prose(3)}</div>")],
    [(0, f"<ul>{_links(1, 2)}</ul>"), (1, f"<h2>{_prose(5)}</h2><div>{_prose(33)}</div><div>{_prose(9)}</div><div>{_prose(41)}</div>"),
     (0, f"<div>{_prose(6)} <a href='/'>{_prose(6)}</a></div><div>{_prose(4)}</div>")],
    [(0, f"<p><a href='/'>{_prose(3)}</a> <a href='/a'>{_prose(2)}</a> {_prose(1)}</p><p><a href='/'>{_prose(14)}</a></p>"),
     (1, f"<p>{_prose(120)}</p><p>{_prose(18)}</p><p>{_prose(70)} <a href='/'>{_prose(3)}</a></p><p>{_prose(50)}</p>"),
     (0, f"<p><a href='/'>{_prose(12)}</a></p><p><a href='/'>{_prose(20)}</a></p><div>{_prose(2)}</div>")],
    [(1, f"<p>{_prose(22)}</p>")], [(1, f"<p>{_prose(40)}</p>")], [(1, f"<p>{_prose(15)}</p><p>{_prose(28)}</p>")],
    [(1, f"<p>{_prose(55)}</p><p>{_prose(3)}</p><p>{_prose(62)}</p>")],
    [(0, f"<div>{_prose(2)}</div>"), (1, f"<p>{_prose(48)}</p><p>{_prose(5)}</p><p>{_prose(2)}</p><p>{_prose(71)}</p>"), (0, f"<div>{_prose(4)}</div>")],
    [(0, f"<div>{_prose(5)}</div>"), (1, f"<p>{_prose(90)}</p><p>{_prose(4)}</p><p>{_prose(40)}</p>"), (0, f"<ul>{_links(3, 2)}</ul><div>{_prose(5)}</div>")],
    [(1, f"<div>{_prose(26)}</div><p>{_prose(19)}</p><p>{_prose(31)}</p>")],
    [(0, f"<ul>{_links(1, 2)}</ul>"), (1, f"<p>{_prose(33)}</p>"), (0, f"<p>{_prose(2)}</p>")],
    [(0, f"<aside><p>{_prose(45)}</p></aside>"), (1, f"<p>{_prose(50)}</p>"), (0, f"<div class='comment'>{_prose(50)}</div><footer>{_prose(9)}</footer>")],
    [(0, f"<div>{_prose(3)}</div>"), (1, f"<h1>{_prose(8)}</h1><p>{_prose(64)}</p>"), (0, f"<div>{_prose(4)}</div><div>{_prose(3)}</div>")],
    [(1, f"<h1>{_prose(4)}</h1><p>{_prose(30)}</p>"), (0, f"<div class='sidebar'><p>{_prose(30)}</p></div>")],
    [(0, f"<div id='cookie-notice'><p>{_prose(28)}</p></div>"), (1, f"<p>{_prose(35)}</p><p>{_prose(17)}</p>"), (0, f"<ul>{_links(2, 2, 2)}</ul>")],
]


def trained(pages: list[list[tuple[int, str]]] | None = None) -> Tree:
    return fit(*labelled_rows(LABELLED if pages is None else pages))


def main_text(page: str | None, tree: Tree) -> tuple[str, int, int]:
    """(text, blocks, content blocks) of a page."""
    found = blocks(page)
    if not found:
        return "", 0, 0
    content = tree.predict(features(found))
    return " ".join(b.text for b, keep in zip(found, content) if keep), len(found), int(content.sum())


def extract(rows: DataFrame, column: str = "html", tree: Tree | None = None) -> DataFrame:
    """The rows' columns, then text, n_chars (its code points), n_blocks and n_content of the page in ``column``."""
    tree = trained() if tree is None else tree

    @F.pandas_udf("text string, n_blocks int, n_content int")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages in batches:
            yield pd.DataFrame([main_text(p, tree) for p in pages], columns=["text", "n_blocks", "n_content"])

    kept = [c for c in rows.columns if c not in ("text", "n_chars", "n_blocks", "n_content")]
    # the rows travel as one column, so that no name of theirs can meet that of the result
    packed = rows.select(F.struct(*kept).alias("row"), read(F.col(column)).alias("page"))
    return packed.select(
        "row.*", "page.text", F.length("page.text").cast("long").alias("n_chars"), "page.n_blocks", "page.n_content")
