import random
from html.parser import HTMLParser

import numpy as np
import pytest

from tidewatch.llm import main_text
from tidewatch.llm.main_text import blocks, features, fit


@pytest.fixture(scope="module")
def tree():
    return main_text.trained()


class Article(HTMLParser):
    """Text of the article element by the standard library's parser, a space at every element that is not inline."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.off, self.parts = 0, 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.off += tag in ("aside", "form", "footer", "nav") or ("class", "ad") in attrs and tag == "div"
        self.parts.append("" if tag in ("b", "i", "a", "span") else " ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.off -= tag in ("aside", "form", "footer", "nav")
        if tag == "div" and self.off:
            self.off -= 1
        self.parts.append("" if tag in ("b", "i", "a", "span") else " ")

    def handle_data(self, data):
        if self.depth and not self.off and self.cdata_elem is None:
            self.parts.append(data)


def by_parser(page):
    parser = Article()
    parser.feed(page)
    parser.close()
    return " ".join("".join(parser.parts).split())


def random_page(rnd):
    words = ["the", "of", "größe", "a", "&amp;", "&lt;b&gt;", "&eacute;", "&#233;", "x", "\n", "&nbsp;", "日本", "&copy;"]
    text = lambda most: " ".join(rnd.choice(words) for _ in range(rnd.randint(1, most)))
    inline = lambda: rnd.choice([text(8), f"<b>{text(3)}</b>{text(2)}", f"<a href='/?a=1&b=2'>{text(2)}</a> {text(9)}", f"{text(3)}<br>{text(2)}"])
    piece = lambda: rnd.choice([
        f"<p>{inline()}</p>", f"<p>{inline()}", f"<h2>{text(4)}</h2>", f"<ul><li>{inline()}<li>{inline()}</ul>", f"<!-- {text(2)} <p> -->",
        f"<div class='ad'>{text(30)}</div>", f"<aside><p>{text(40)}</p></aside>", f"<form>{text(9)}<input></form>",
        f"<script>var s = '<p>{text(3)}</p>';</script>", f"<style>p {{}} </style><blockquote>{inline()}</blockquote>", f"<table><tr><td>{text(3)}<td>{text(2)}</table>"])
    outer = lambda: rnd.choice(
        [f"<nav><ul><li><a href='/'>{text(3)}</a></li></ul></nav>", f"<div class=\"ad\">{text(30)}</div>", f"<footer>{text(40)}</footer>",
         f"<div id='cookie-notice'><p>{text(30)}</p></div>", "",
         f"<aside>{text(50)}</aside>"])
    return (f"<!DOCTYPE html><html><head><title>{text(5)}</title><meta charset='utf-8'></head><body>" + outer() + outer() + "<article><h1>"
            + text(6) + "</h1>" + "".join(piece() for _ in range(rnd.randint(0, 9))) + "</article>" + outer() + outer() + "</body></html>")


def test_articles_against_parser(tree):
    rnd = random.Random(5)
    for _ in range(300):
        page = random_page(rnd)
        assert main_text.main_text(page, tree)[0] == by_parser(page), page


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("<", ""), ("<p", ""), ("<!-- open", ""), ("<script>x", ""), ("<article>a &am", "a &am"), ("<article>a &amp", "a &"),
    ("<article>a<p>b</article", "a b"), ("<article>a < b > c<p>1 <2</article>", "a < b > c 1 <2"), ("<article><p class='x>y'>q</p></article>", "q"),
    ("<article>x<b>y</b>z</article>", "xyz"), ("<article>x<div>y</div>z</article>", "x y z"), ("<article>a \n b</article>", "a b"),
    ("<article><h1>T</h1><div class='share-buttons'>Tweet</div><p>b</p><section id='comments'><article>me too</article></section></article>", "T b"),
    ("<article><p>a</p><textarea><p>no</p></textarea><noscript>no</noscript><p hidden>no</p><p style='display: none'>no</p>b</article>", "a b"),
    ("<ARTICLE><P>A</P><SCRIPT>1</SCRIPT></ARTICLE>", "A"), ("<article></article>", ""), ("<p><b>" + "word " * 30 + "<br><p>" + "word " * 25, "word " * 54 + "word"),
    ("<nav>" + "w " * 50 + "</nav>", ""), ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ("<article>" + "<b>x" * 20000, "x" * 20000),
])
def test_odd_pages(tree, page, want):
    assert main_text.main_text(page, tree)[0] == want


def test_blocks_and_neighbours():
    found = blocks("<ul><li><a href='/'>one two</a></li></ul><p>a b <a href='/'>c</a> d</p><h1>t</h1>")
    assert [(b.text, b.words, b.linked, b.heading) for b in found] == [("one two", 2, 2, False), ("a b c d", 4, 1, False), ("t", 1, 0, True)]
    assert features(found)[1].tolist() == [0, 0, 0, 4, 0.25, 2, 1.0, 1, 0.0]
    assert features([]).shape == (0, 9)


def test_tree_is_learned(tree):
    rows, labels = main_text.labelled_rows(main_text.LABELLED)
    assert (tree.predict(rows) == labels).all() and labels.any() and not labels.all()
    # pages left out of the table one by one
    right = []
    for i, page in enumerate(main_text.LABELLED):
        without = main_text.trained(main_text.LABELLED[:i] + main_text.LABELLED[i + 1:])
        x, y = main_text.labelled_rows([page])
        right += (without.predict(x) == y).tolist()
    assert np.mean(right) > 0.8
    assert fit(rows[:0], labels[:0]).predict(rows[:1]).tolist() == [False]
    assert fit(rows[:1], labels[:1]).predict(rows[:1]).tolist() == [labels[0]]


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<article>é &lt;</article>", "x", 1.0), (1, "u", "<article>é &lt;</article>", "x", 1.0), (None, None, None, None, None)],
        "page_id long, url string, html string, text string, row double")
    got = main_text.extract(pages).select("page_id", "url", "row", "text", "n_chars", "n_content").collect()
    assert sorted(map(tuple, got), key=repr) == [(1, "u", 1.0, "é <", 3, 1)] * 2 + [(None, None, None, "", 0, 0)]
    assert main_text.extract(pages.limit(0)).count() == 0
