"""Blocks of pages: named corners, broken markup, and that no visible text is lost."""

from __future__ import annotations

import random

import pytest

from factloom.sources import html as hx


def blocks(html):
    return hx.Blocks(hx.Tree(html).root).out


def kinds(html):
    return [(b[1], b[8]) for b in blocks(html)]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>a<p hidden>x<p>visible after", [("paragraph", "a"), ("paragraph", "visible after")]),
        ("<ol><li>x<li>y</ol>z", [("list", None), ("list_item", "x"), ("list_item", "y"), ("paragraph", "z")]),
        ("<p>one<br>two<wbr>three</p>", [("paragraph", "one twothree")]),
        ("<div style='visibility: hidden'>x</div><div style='display:none'>y</div>z<script>q</script><ix:header><p>h</p></ix:header>", [("paragraph", "z")]),
        ("<ul><li>a<ul><li>b</li></ul>c</li></ul>", [("list", None), ("list_item", "ac"), ("list", None), ("list_item", "b")]),
        ("<table><tr><td>1<td>2<tr><td> <td>4</table>end", [("table", "1 | 2\n | 4"), ("paragraph", "end")]),
        ("<table><tr><td><p>Item 1. Business</p></td></tr></table>", [("paragraph", "Item 1. Business")]),
        ("<table><tr><td>Item 7</td> <td>MDA</td></tr></table>", [("paragraph", "Item 7"), ("paragraph", "MDA")]),
        ("<p class='footnote'>f</p><p>/s/ Someone</p><div id='signatures'>Signed</div>", [("footnote", "f"), ("signature", "/s/ Someone"), ("signature", "Signed")]),
        ("<h2>Part I</h2>text <b>bold</b> more<h3></h3>", [("heading", "Part I"), ("paragraph", "text bold more")]),
        ("a</p></div></b>b<b>c<p>d</b>e", [("paragraph", "abc"), ("paragraph", "de")]),
        ("<div>&nbsp;x&#8239; y\n\n</div>", [("paragraph", "x y")]),
        ("<span>in <div>block</div> after</span>", [("paragraph", "in"), ("paragraph", "block"), ("paragraph", "after")]),
        ("<header>seen</header><ix:nonNumeric>kept</ix:nonNumeric>", [("paragraph", "seen"), ("paragraph", "kept")]),
        ("", []),
        ("<body hidden>x", []),
    ],
)
def test_corners(html, want):
    assert kinds(html) == want


def test_signals_and_parents():
    out = blocks('<h1 id="top"><a href="#x">Go</a> on</h1><p style="font-weight: 700">b</p><ul><li>i<ol><li>j</ol></ul>')
    assert out[0] == (None, "heading", 1, False, "top", 1, 2, 5, "Go on") and out[1][3]
    assert [b[0] for b in out] == [None, None, None, 2, 3, 4]


def test_no_visible_text_is_lost():
    """Words of random broken markup without hidden parts all come back, once and in order but for nested lists."""
    rng = random.Random(8)
    tags = "p div span b li ul ol table tr td th h2 section a i tbody".split()
    for _ in range(1500):
        parts, n = [], 0
        for _ in range(rng.randint(1, 25)):
            t = rng.choice(tags)
            parts.append(rng.choice([f"<{t}>", f"</{t}>", "<br>", f" w{n} ", f" w{n} "]))
            n += "w" in parts[-1]
        html = "".join(parts)
        words = [w for b in blocks(html) if b[8] for w in b[8].replace("|", " ").split()]
        assert sorted(words) == sorted(w for p in parts if p.startswith(" w") for w in p.split()), html


def test_deep_and_large_pages(spark):
    rows = [(1, "<div>" * 5000 + "deep" + "</div>" * 10 + "<p>more"), (2, None), (3, ""), (4, "<p>x</p>" * 20_000), (None, "plain"), (None, "plain")]
    got = hx.html_blocks(spark.createDataFrame(rows, "doc_id long, html string")).collect()
    by = {d: [r for r in got if r.doc_id == d] for d in (1, 2, 3, 4, None)}
    assert [len(by[d]) for d in (1, 2, 3, 4, None)] == [2, 0, 0, 20_000, 2] and [r.text for r in by[1]] == ["deep", "more"]
    assert [r.ordinal for r in by[4][:3]] == [0, 1, 2]


def test_index_page(spark):
    page = """<table class="tableFile"><tr><th>Seq<th>Description<th>Document<th>Type<th>Size</tr><tr><td>1<td>Annual report<td><a href="/Archives/a/f.htm">f.htm</a><td>10-K<td>9</tr>
      <tr><td>&nbsp;<td><td><a href="ex.pdf"></a><td><td>1</tr><tr><td>3<td>no link<td>x<td>y</tr><tr><td>4<td>short</tr></table><table><tr><td>9<td>9<td><a href=z>z</a><td>9</table>"""
    rows = [("a1", "https://h/a/", page), ("a2", None, ""), ("a3", None, None)]
    got = hx.index_html_rows(spark.createDataFrame(rows, "accession string, base string, html string")).collect()
    assert [tuple(r) for r in got] == [
        ("a1", 0, "1", "Annual report", "f.htm", "10-K", "https://www.sec.gov/Archives/a/f.htm"), ("a1", 1, None, None, "ex.pdf", None, "https://h/a/ex.pdf"),
    ]
