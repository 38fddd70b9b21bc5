"""Rendered text of pages."""

import itertools
import random
import re
import time

import pytest
from conftest import FOLDER

from tidemark.llm.html import extract, render
from tidemark.llm.queries import registered

CASES = [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<p>one</p>\n  <p>two  words</p>", "one\n\ntwo words"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("<div><div>a</div></div><span>b</span> <b>c</b>", "a\nb c"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<li><p>a</p><p>b</p></li>", "- a\n\n  b"),
    ("<dl><dt>term<dd>what it is</dl>", "term\n  what it is"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"),
    ("<table><tr><th>Name<th>No<tr><td>apple<td>12<tr><td>fig<td>3</table>", "Name  | No\napple | 12\nfig   | 3"),
    ("<table><td>a<td>b</table>", "a | b"),
    ("<table><tr><td>wide cell<td>x<tr><td colspan=2>both</table>", "wide cell | x\nboth"),
    ("<table><tr><td><p>a</p><p>b</p><td>c</table>", "a b | c"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a in | ner | b"),
    ("x<table><caption>T</caption><tr><td>a</table>y", "x\n\nT\na\n\ny"),
    ("<title>no</title><script>var a = '<p>no</p>';</script><style>p{}</style>yes", "yes"),
    ("<script>if (a </ b) {}</script>yes", "yes"),
    ("<p hidden>no</p><p style='DISPLAY : none'>no</p><p style='color:red'>yes", "yes"),
    ("<dialog>no</dialog><dialog open>yes</dialog><noscript>no</noscript>", "yes"),
    ("<nav>menu</nav><!-- no <p> --><footer>&copy; us</footer>", "menu\n© us"),
    ("a < b and c > d", "a < b and c > d"),
    ("a<b", "a"),
    ("<a href='x>y' title=\"q\">link</a>", "link"),
    ("<p>a<!-- not closed", "a"),
    ("<!DOCTYPE html><html><head><meta x><body>b", "b"),
    ("<p><b>bold<br></article>on", "bold\non"),
    ("</p>a</div></table>b", "ab"),
    ("<option>a<option>b", "a\nb"),
    ("a&nbsp;b&#x41;&bogus;", "a bA&bogus;"),
    ("<textarea> a\n b</textarea>", "a\n b"),
]


RULES = [
    ('<div style="visibility:hidden">no<span style="visibility:visible">YES</span>no</div>on', "YES\non"),
    ('<div style="display:none">no<b style="display:block;visibility:visible">no</b></div>yes', "yes"),
    ('<div style="/*display:none*/">yes', "yes"),
    ("<p style='display:none;display:block'>yes<p style='display:none!important;display:block'>no", "yes"),
    ("<p style='background:url(a;display:none)'>a<p style='content:\"display:none;\"'>b", "a\n\nb"),
    ("<p style='display:none;/*'>no<p style='x-display:none'>yes", "yes"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td>a<td rowspan=2>bb<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a | bb | c\nd |    | e\nf | g"),
    ("<table><tr><td rowspan=0 colspan=2>a<td>b<tr><td>c<tr><td>d</table>", "a   | b\n |  | c\n |  | d"),
    ("<b><p>x</b>y</p>z", "xy\n\nz"),
    ("<p><i>a<b>b</i>c</b>d</p>", "abcd"),
    ("<ul><li><a>x<p>y</a>z</ul>", "- x\n\n  yz"),
    ("<input type=submit value=Go> <input type=SUBMIT> <input type=hidden value=no><input value='me'>", "Go Submit me"),
    ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
    ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"),
    ("<ol reversed start=9><li>a<li>b</ol>", "9. a\n8. b"),
    ("<ol><li style='visibility:hidden'>no<li>b</ol>", "2. b"),
    ("w<td>b", "w b"),
]


@pytest.mark.parametrize("page,text", RULES)
def test_rules_of_visibility_and_layout(page, text):
    assert render(page) == text


def random_page(rng, words, depth=0, shown=True, visible=True):
    """Markup of random elements, and the words of it that can be seen, in order."""
    page, seen = [], []
    for _ in range(rng.randint(1, 4)):
        word = f"w{next(words)}"
        page.append(rng.choice((word + " ", f" {word}\n", f"<!-- {word} no -->{word} ")))
        seen += [word] if shown and visible else []
        if depth > 4 or rng.random() < 0.3:
            continue
        tag = rng.choice(("div", "span", "b", "section", "ul", "ol", "blockquote", "table", "script", "dialog"))
        rule = rng.choice(("", "", "", "hidden", "none", "invisible", "visible", "comment"))
        style = {"none": "color:red; Display : none", "invisible": "visibility:hidden", "visible": "visibility:visible"}
        style["comment"] = "/*display:none*/"
        attribute = "hidden" if rule == "hidden" else f"style='{style[rule]}'" if rule else rng.choice(("", "class=x"))
        if tag == "script":
            page.append(f"<script {attribute}>var no = '<p>no</p>';</script>")
            continue
        inner_shown = shown and rule not in ("hidden", "none") and tag != "dialog"
        inner_visible = {"invisible": False, "visible": True}.get(rule, visible)
        inner, inner_seen = [], []
        for _ in range(rng.randint(1, 3)):
            part, part_seen = random_page(rng, words, depth + 1, inner_shown, inner_visible)
            if tag in ("ul", "ol"):
                part = f"<li>{part}" + rng.choice(("", "</li>"))
            elif tag == "table":
                part = f"<tr><td>{part}" + rng.choice(("", "</td>", "</td></tr>"))
            inner.append(part)
            inner_seen += part_seen
        page.append(f"<{tag} {attribute}>{''.join(inner)}</{tag}> ")
        seen += inner_seen
    return "".join(page), seen


def test_random_pages_show_their_visible_words_in_order():
    for seed in range(400):
        page, seen = random_page(random.Random(seed), itertools.count())
        assert re.findall(r"w[0-9]+", render(page)) == seen and "no" not in render(page), page


QUOTES = [
    ('<p class=x">visible text</p><p>more text</p>', "visible text\n\nmore text"),
    ("<a title='it's'>link</a> more text", "link more text"),
    ("<p title='it's hidden'>yes", "yes"),
    ("<p title='a>b' hidden>no</p>yes", "yes"),
    ('<p "hidden">yes</p><p class = "a>b">on', "yes\n\non"),
    ("<p ='a>b", "b"),
    ("<p class=>a</p><p class=a'b>c</p>'d", "a\n\nc\n\n'd"),
    ("<p style=display:none>no</p><p style=\"display:none'>\">no</p>yes", "yes"),
    ('<a href="x"title="y>z">link</a \'> on', "link on"),
    ("a<!-->b<!--->c<!-- x --!>d<!-- -- > -->e", "abcde"),
    ("<!-->visible<p>text", "visible\n\ntext"),
]


@pytest.mark.parametrize("page,text", QUOTES)
def test_stray_quotes_hide_nothing(page, text):
    assert render(page) == text


def test_quotes_take_time_in_proportion():
    started = time.process_time()
    for piece in ("<a '", "<a b='", "<a b=\"'>", "<a = ", "<!-->", "a=b' ", " =", "<a b   "):
        render(piece * 50_000)
        render("<a " + piece * 50_000)
    assert time.process_time() - started < 20


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert render(page).strip(" ") == text


def test_hostile_pages_take_time_in_proportion():
    started = time.process_time()
    for piece in ("<div>", "<p><li>x", "<a \"", "<", "<table><tr><td>", "<b></p>", "<ul><li>x", "</div>", "<!--", "<p>a<span>", "<i></u>", "<tr><td rowspan=9999>x"):
        render("<table><u><p>" + piece * 20_000)
        render(piece * 20_000)
    assert time.process_time() - started < 20


def test_wide_cells_do_not_widen_the_others():
    rows = "<tr><td>" + "w" * 10_000 + "<td>x" + "<tr><td>a<td>b" * 200
    assert len(render(f"<table>{rows}</table>")) < 30_000


def test_given_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = {r["page_id"]: r for r in registered()["op3_html_text"](spark, FOLDER).collect()}
    assert found.keys() == pages.keys()
    for page_id, row in found.items():
        assert row["text"] == render(pages[page_id]) and row["n_chars"] == len(row["text"])
        assert "track(" not in row["text"] and "<p" not in row["text"]


def test_columns_stay(spark):
    rows = [(1, None, "t", 2), (1, None, "t", 2), (None, "<p>x", "u", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string, _text int")
    found = extract(pages)
    assert found.columns == ["page_id", "_text", "text"]
    assert sorted(map(tuple, found.collect()), key=repr) == [(1, 2, ""), (1, 2, ""), (None, None, "x")]
    assert extract(pages.where("false")).count() == 0
