import time
from html.parser import HTMLParser

import pytest

from socialcart.llm import queries
from socialcart.llm.html_extraction import extract, render
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("page, text", [
    ("<p>a<p>b<ul><li>x<li>y<ol start=3><li>n<li>m</ol><li>z</ul>c", "a\n\nb\n\n- x\n- y\n  3. n\n  4. m\n- z\n\nc"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td colspan=2>whole row<tr><td>pear<td>12</table>end",
     "Name       Qty\napple pie  3\nwhole row\npear       12\n\nend"),
    ("<table>stray<tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "stray\n\na  b\n   c"),
    ("<table><tr><td>one<br>two<td>x<tr><td>3<td>y</table>", "one  x\ntwo\n3    y"),
    ("<table><tfoot><tr><td>foot</tfoot><tbody><tr><td>body<table><tr><td>in<td>ner</table></table>", "body\n\nin  ner\nfoot"),
    ("<div hidden>no</div><b style='visibility:hidden'>no<i style='visibility:visible'>yes</i></b><p style='display: none'>no", "yes"),
    ("<pre>\n a  b\n  c</pre>x &lt;y&gt; <3 <a href='x>y'>link</a><br><br>z", " a  b\n  c\n\nx <y> <3 link\n\nz"),
    ("<dl><dt>t<dd>d1<dd>d2</dl><blockquote>q<p>r</blockquote>", "t\n  d1\n  d2\n\n  q\n\n  r"),
    ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details><dialog>no</dialog>", "s\nt\nyes"),
    ("<select><option>1<option selected>2</select><input type=submit value=Go><input type=hidden value=no>", "2 Go"),
    ("<title>T</title><style>p{}</style><script>var t='</p>';</script>a<!-- no --><noscript>no</noscript>", "a"),
    ("a<b>b<p>c</b>d</p>e</p>f</div>g", "ab\n\ncd\n\ne\n\nfg"),
    ("<h1>x<h2>y</h1>z", "x\n\ny\n\nz"), ("  a \n b<span> c </span> d&nbsp;e ", "a b c d\xa0e"),
    ("<ol reversed><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n6. c"), ("<textarea>\n a <b></textarea>", " a <b>"),
    ("<p \"x>q</p><!-- open", "q"), ("x<p title='a", "x"), ("", ""), ("<", "<"), ("</>a<//b>", "a"), ("a<br></br>b", "a\n\nb"),
    ("<select multiple><option>1<option selected>2</select> <input value=typed><input type=password value=no>", "1 2 typed"),
    ("<select><option selected>1<option selected>2</select>", "2"),
    ("<b style='display:none;display:block'>yes</b><b style='display:block;display:none'>no</b>", "yes"),
    ("<ul>text <b>bold</b> more<li>x</ul>", "text bold more\n- x"),
    ("<table>a<table>b<tr>c<td>d</table>e<tr>f<td>g</table>h", "abc\n\nd\n\nef\n\ng\n\nh"),
    ("<table><tr><td rowspan=3>a<td rowspan=2 colspan=2>b<td>c<tr><td>d<tr><td>e<td>f<td>g</table>", "a  b     c\n         d\n   e  f  g"),
    ("<script>open", ""), ("<plaintext><b>x", "<b>x"), ("&copy; &#65;&amp;lt;", "© A&lt;"),
])
def test_layout(page, text):
    assert render(page)[1] == text


def test_title_deep_and_long_pages():
    assert render("<head><title> a\n b &amp; c </title><body>x") == ("a b & c", "x")
    assert render("<div>" * 20_000 + "deep" + "<table><tr><td>" * 300 + "cell")[1].split() == ["deep", "cell"]
    wide = "<table>" + "<tr><td>" + "x" * 100_000 + "<td>y" + "<tr><td>a<td>b" * 300 + "</table>"
    assert len(render(wide)[1]) < 130_000
    assert len(render("<p>word " * 50_000)[1].split()) == 50_000


def test_time_is_linear_in_misplaced_children_and_spanning_rows():
    for page in ("<table>" + "x<br>" * 100_000 + "<tr><td>end</table>",
                 "<table>" + "<tr><td rowspan=65000 colspan=1000>x" * 10_000 + "</table>",
                 "<table>" + "<tr><td rowspan=65000>x" * 10_000 + "</table>", "<table><tr><td>x</table>" * 10_000):
        begun = time.process_time()
        assert render(page)[1].count("x") == page.count(">x")
        assert time.process_time() - begun < 10  # seconds; each takes about one


class _Plain(HTMLParser):
    """All character data outside head elements, blocks apart."""

    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")
        self.out.append(" " if tag not in ("b", "a") else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")
        self.out.append(" " if tag not in ("b", "a") else "")

    def handle_data(self, data):
        self.out.append("" if self.hidden else data)


def test_query_has_all_visible_words(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.queries()["op1_html_extraction"](spark, SF_SMALL).collect()
    assert {r.page_id for r in got} == pages.keys()
    for r in got:
        plain = _Plain()
        plain.feed(pages[r.page_id])
        plain.close()
        assert [w for w in r.text.split() if w != "-"] == [w for w in "".join(plain.out).split() if w != "-"]
        assert r.n_chars == len(r.text) and r.title


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, title int"
    rows = [(1, None, None, "t", 1), (None, "u", "", None, 1), (2, "u", "<p>a", "t", None), (2, "u", "<p>a", "t", None)]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        [(1, None, None, None), (None, "", "", 0), (2, "", "a", 1), (2, "", "a", 1)], key=str)
    assert extract(spark.createDataFrame([], schema)).count() == 0
