from __future__ import annotations

import random
import re
from html.parser import HTMLParser

from strata.llm import html_render as h
from strata.llm.queries import op10_html_render
from tests.llm.conftest import SF


class Words(HTMLParser):
    """All words outside head, script and style."""

    def __init__(self):
        super().__init__()
        self.off, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("head", "script", "style")
        self.out.append(" " if tag in h.BLOCK or tag == "br" else "")

    def handle_endtag(self, tag):
        self.off -= tag in ("head", "script", "style")
        self.out.append(" " if tag in h.BLOCK else "")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def words(html):
    p = Words()
    p.feed(html)
    p.close()
    return "".join(p.out).split()


def test_query_keeps_every_visible_word(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = op10_html_render(spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        got = re.sub(r"(?m)^ *(?:- |\d+\. )", "", r["text"]).split()
        assert got == [w for w in words(pages[r["page_id"]])]
        assert r["n_chars"] == len(r["text"]) and r["n_lines"] == r["text"].count("\n") + 1


def test_edges(spark):
    rows = [(0, None), (1, ""), (2, "   "), (3, "plain"), (4, "<p"), (5, "<!-- open"), (6, "<div>" * 3000 + "deep"), (7, "a" * 200_000), (None, "<b>x"), (3, "plain")]
    df = spark.createDataFrame([(i, t, "u", 1) for i, t in rows], "page_id long, html string, text string, part int")
    got = sorted(((r["page_id"], r["text"]) for r in h.rendered(df).collect()), key=str)
    want = [(0, ""), (1, ""), (2, ""), (3, "plain"), (3, "plain"), (4, ""), (5, ""), (6, "deep"), (7, "a" * 200_000), (None, "x")]
    assert got == sorted(want, key=str)
    assert h.rendered(spark.createDataFrame([], "page_id long, html string")).collect() == []


def test_blocks_and_white_space():
    assert h.render("<h1>A</h1><p>one  <b>t</b>wo\n three<p>four<div>x</div><div>y<br>z</div>") == "A\n\none two three\n\nfour\n\nx\ny\nz"
    assert h.render("<pre>a\n  b\n</pre>c") == "a\n  b\n\nc"
    assert h.render("<nav><ul><li>n</ul></nav><div>d</div>") == "- n\n\nd"


def test_lists():
    assert h.render("<ol start=9><li>a<li>b<ul><li>c<li>d</ul><li>e</ol>") == "9. a\n10. b\n    - c\n    - d\n11. e"


def test_table_cells_line_up():
    html = "<table><caption>Cap</caption><tr><th>Name<th>N<tr><td>long one<td>1<td>x<tr><td colspan=2>ab<td>y</table>after"
    assert h.render(html) == "Cap\nName      N\nlong one  1  x\nab           y\n\nafter"
    assert h.render("<table><tr><td>a<br>b<td>c</table>") == "a  c\nb"


def test_implied_and_stray_tags():
    assert h.render("<p>a<ul><li>b</p>c</ul></div></b>d") == "a\n\n- b\n  c\n\nd"
    assert h.render("<dl><dt>t<dd>d1<dd>d2</dl>") == "t\n  d1\n  d2"
    assert h.render("<head><title>no</title><p>body") == "body"


def test_visibility():
    html = "<style>.x,#y{display:none}</style><p class='a x'>1<p id=y>2<p hidden>3<p style='visibility: hidden'>4<p>5<template>6</template><noscript>7</noscript><details><summary>s</summary>8</details>&lt;9&gt;"
    assert h.render(html) == "5\n\ns\n\n<9>".replace("\n\n<9>", "\n<9>")


def test_rules_of_other_media_and_conditions_do_not_hide():
    body = "<p class=a>a<p class=b>b<p id=c>c<p class='d:e'>d"
    shown = lambda css, attrs="": "".join(h.render(f"<style{attrs}>{css}</style>{body}").split())
    for css in (
        "@media print{.a,.b{display:none}}", "@media (max-width:600px){.a{display:none}}", "@media print, screen and (max-width: 9em) {#c{display:none}}",
        "@supports (display:grid){@media screen{.a{display:none}}}", "@media not screen{.a{display:none}}", "/* .a{display:none} */", "@media print{@layer x{.a{display:none}}}",
        ".a{color:red;@media print{display:none}}", ".a{color:red;.b{display:none}}", ".q:not(.x,.a,.y){display:none}", "@font-face{src:url(data:x;b}c)}@media print{p{x:'}'}.a{display:none}}",
        ".a{display:none}@media (min-width:600px){.a{display:block}}", ".a{display:none}.a{display:block}", "p{display:none}p{display:block!important}p{display:none}",
    ):
        assert shown(css) == "abcd", css
    assert shown(".a{display:none}", " media=print") == "abcd" == shown(".a{display:none}", " type=text/plain")
    for css in (
        "@media print{.b{display:none}}.a{display:none}", "@media screen{.a{display:none}}", "@media all , print{.a{display:none}}", "@media not print{.a{display:none}}", "@import url(x);.a{display:none}",
        "@layer u{.a{display:none}}", ".q::before{content:'}'}.a{display:none", "/* { */.a{display:none}", "<!-- .a{ display : none } -->", ".a{@media screen{display:none}}",
        ".a{display:none}p{display:block}", "@media(min-width:1px){.a{display:block}}.a{display:none}",
    ):
        assert shown(css) == "bcd", css
    assert shown(".d\\:e{display:none}") == "abc" and shown("@media print{}.a,#c{visibility:hidden}") == "bd"
    assert shown("</style><noscript><style>.a{display:none}</style></noscript><style>") == "abcd"


def test_formulas():
    math = "<math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow><annotation encoding='x'>E=mc^2</annotation><annotation-xml><ci>no</ci></annotation-xml></semantics></math>"
    assert h.render(f"<p>So {math}, as shown") == "So E=mc2, as shown"
    assert h.render("<math><mfrac><mn>1</mn><mn>23</mn></mfrac><mtext>if <b>x</b></mtext><mphantom><mi>z</mi></mphantom></math>") == "1 23 if x"
    assert h.render("<math><mtable><mtr><mtd>a</mtd><mtd>b</mtd></mtr><mtr><mtd>c</mtd><mtd>d</mtd></mtr></mtable></math>") == "a b c d"


def test_text_of_drawings():
    svg = "<svg width=9><title>T</title><desc>D</desc><metadata>M</metadata><defs><text>no</text></defs><style>.h{display:none}</style>raw<g><text x=1>Start</text><text><tspan x=0>one</tspan><tspan x=0 dy=9>t<tspan>wo</tspan></tspan></text></g><path d='M0 0'/><text class=h>no</text><text display=none>no</text><symbol><text>no</text></symbol><foreignObject><div>box</div></foreignObject></svg>"
    assert h.render(f"<p>See{svg}here") == "See Start one two\nbox\nhere"
    assert h.render("<p>a<svg><title/><text>b</text></svg>c<desc>d</desc><text>e</text>") == "a b cde"
    assert h.render("<svg><g><rect><p>out<p>side") == "out\n\nside"  # HTML ends an open drawing
    assert h.render("<div>" * 150 + "<svg>" + "<g>" * 100 + "<text>deep") == "deep"


def test_visibility_is_inherited_and_taken_back():
    assert h.render("<div style='visibility:hidden'>a<p style='visibility:visible'>b<i>c</i></p>d<ul><li>e<li style='visibility:visible'>f</ul></div>g") == "bc\n\n- f\n\ng"
    table = "<table style='visibility:hidden'><tr><td>a<td class=v>b<tr class=v><td>c<td>d</table>"
    assert h.render("<style>.v{visibility:visible}</style>" + table) == "   b\nc  d"
    assert h.render("<p style='visibility:hidden'>a<b style='visibility:inherit'>b</b><span style='display:none'><i style='visibility:visible'>c</i></span>") == ""
    assert h.render("<svg><g visibility=hidden><text>a</text><text visibility=visible>b</text></g></svg>") == "b"


def test_display_decides_on_lines():
    assert h.render("<span style='display:block'>alpha</span><span style='display:block'>beta</span>") == "alpha\nbeta"
    assert h.render("<style>.b{display:flex}li{display:inline}</style><b class=b>x</b><i>y</i><div style='display:inline'>z</div>") == "x\ny z"
    assert h.render("<style>@media (min-width:9em){b{display:block}}</style>a<b>b</b>") == "ab"


def test_nothing_is_lost_below_the_depth_limit():
    for n in (150, 198, 199, 200, 201, 5000):
        deep = "<div>" * n
        assert h.render(deep + "a<div style='display:none'>no<p>no</p>no</div>b<b>c</b>d" + "</div>" * n + "<p>e").replace("\n", "") == "abcde", n
        assert h.render("<p hidden>no</p><div style='visibility:hidden'>" + deep + "no<p style='visibility:visible'>yes</p>no" + "</div>" * n + "no</div>z").split() == ["yes", "z"], n
    assert h.render("<div>" * 300 + "<details><summary>s</summary>no<b>no</b></details>t").split() == ["s", "t"]


def test_hostile_nesting_takes_linear_time():
    import time

    at = time.time()
    for html in ("<div>" * 100_000 + "x", "<p><button>" + "<div>" * 100_000 + "x", "<b>" * 50_000 + "x" + "</i></b>" * 50_000, "<table><tr><td>" * 30_000 + "x"):
        assert h.render(html) == "x"
    assert time.time() - at < 20


def test_list_numbers():
    assert h.render("<ol><li>a<li value=5>b<li>c</ol>") == "1. a\n5. b\n6. c"
    assert h.render("<ol reversed><li>a<li>b<li hidden>x<li>c</ol>") == "3. a\n2. b\n1. c"
    assert h.render("<ol type=a start=26><li>a<li>b</ol>") == "z. a\naa. b"
    assert h.render("<ol type=I start=1994><li>a<li type=i value=4>b</ol>") == "MCMXCIV. a\niv. b"


def test_cells_that_span_rows_keep_their_place():
    html = "<table><tr><td rowspan=2>k<td>a<td>b<tr><td>cc<td>d<tr><td>e<td>f<td>g</table>"
    assert h.render(html) == "k  a   b\n   cc  d\ne  f   g"
    assert h.render("<table><tbody><tr><td rowspan=0>k<td>a<tr><td>b<tr><td>c<tbody><tr><td>d<td>e</table>") == "k  a\n   b\n   c\nd  e"
    assert h.render("<table><tr><td colspan=300>a<td>b<tr><td colspan=300>cc<td>d</table>") == "a   b\ncc  d"
    assert h.render("<table><tr><td>字<td>x<tr><td>abc<td>y</table>") == "字   x\nabc  y"


def test_a_grid_of_spans_equals_a_plain_one():
    """Places by filling a grid cell by cell."""
    r = random.Random(5)
    for _ in range(200):
        rows = [(r.randint(0, 9) // 8, [(["x"], r.choice([1, 1, 2, 3]), r.choice([1, 1, 2, 3, 0])) for _ in range(r.randint(0, 4))]) for _ in range(6)]
        rows.sort(key=lambda x: x[0])
        filled, want = set(), []
        for i, (g, row) in enumerate(rows):
            col, here = 0, []
            for lines, wide, down in row:
                while (i, col) in filled:
                    col += 1
                here.append((col, lines))
                for k in range(i, len(rows) if down == 0 else min(i + down, len(rows))):
                    if rows[k][0] == g:
                        filled |= {(k, c) for c in range(col, col + wide)}
                col += wide
            want.append(here)
        assert h.placed(rows) == want


def test_padding_is_bounded():
    cell = "y" * 10_000
    html = f"<table><tr><td>{cell}<td>z" + "<tr><td>a<td>b" * 2000 + "</table>"
    got = h.render(html)
    assert len(got) < 17 * len(html) and got.split() == [cell, "z"] + ["a", "b"] * 2000
    wide = "<table><tr>" + "<td rowspan=60000>a" * 2000 + "<tr><td>b" * 2000 + "</table>"
    assert len(h.render(wide)) < 17 * len(wide)


def test_title():
    assert h.title("<title> a &amp;\n b </title>") == "a & b" and h.title("<p>") is None
