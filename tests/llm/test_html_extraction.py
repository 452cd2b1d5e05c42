"""HTML extraction: pages with known texts, votes counted by hand, broken markup, hot hosts."""

import random
import re
import time
from collections import defaultdict

import pytest

from effort_analytics.llm import html_extraction as X

SCHEMA = "page_id long, url string, html string, host string, paths int, salt int, text string"
LONG = "This sentence is long enough to stand for a paragraph of an article, with commas, and a stop."


def _text(page):
    return X.extract(X.read(page), None)


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""),
    ("<html><body><nav><a href=/>Home</a></nav><article><h1>T &amp; U</h1><p>a  b\n c</p></article><footer>&copy; x</footer></body></html>", "T & U\na b c"),
    ("<article><p>one<p>two<b>three</b> four<br>five", "one\ntwothree four five"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<article><p>x</p><script>var t='</p><article>';</script><style>p{}</style><p>y</p></article>", "x\ny"),
    ("<article><p>x</p><!-- <p>no</p> --><![CDATA[z]]><p>y</p></article>", "x\ny"),
    ("<article><p>a < b and 3 > 2 &lt;i&gt; &#233;&#x41; &nbsp; end</p></article>", "a < b and 3 > 2 <i> éA end"),
    ('<article title="a>b" data-x=\'<p>\'><p class=it\'s>q</p></article>', "q"),
    ("<article><p>cut off</p><p cla", "cut off"),
    (f'<div id="cookie-notice">{LONG}</div><div class="entry-content"><p>{LONG}</p><div class="ad">Buy</div><form><p>mail</p></form><p>end</p></div>', f"{LONG}\nend"),
    (f"<main><article><p>{LONG}</p></article><section id=comments><article><p>{LONG} no</p></article></section></main><aside>{LONG}</aside>", LONG),
    (f'<div class="post no-sidebar"><p>{LONG}</p></div><div hidden>{LONG}</div><div style="display: none">{LONG}</div><div role=navigation>{LONG}</div>', LONG),
    (f'<div class="sidebar">{LONG}</div>', LONG),  # all there is
    ("<article><div><p>x</div></p></span><p>y</p></article></article>", "x\ny"),
    ("<ARTICLE><P>Up</P></ARTICLE><SCRIPT>no", "Up"),
])
def test_pages(source, want):
    assert _text(source) == want


def test_votes_overrule_a_page():
    """A page whose article is short, beside a long text in an unnamed element, follows its host."""
    usual = f"<body><div class=x1><p>{LONG}</p><p>{LONG}</p></div><div class=y><p>short</p></div></body>"
    odd = f"<body><div class=x2><p>tiny</p></div><div class=y><p>{LONG}</p></div></body>"
    assert _text(odd) == LONG
    total = defaultdict(list)
    for s in [usual] * 9 + [odd]:
        for p, v in X.votes(X.read(s)).items():
            total[p].append(v)
    rank = sorted(total, key=lambda p: (-(sum(total[p]) // (len(total[p]) + 1)), -p.count(">"), p))
    assert rank[0] == ">body>div.0" and X.extract(X.read(odd), rank) == "tiny"


def _pages():
    rnd = random.Random(1)
    rows = []
    for i in range(80):
        h = ["http://Hot.example.com/a", "https://u@b.example.org:8080/x?y#z", "//c.example.net", "mailto:x", None][0 if i % 3 else rnd.randrange(5)]
        body = "".join(f"<p>{LONG} {rnd.random()}</p>" for _ in range(rnd.randrange(4)))
        box = rnd.choice(["<article>{}</article>", '<div class="post-{}">'.format(i) + "{}</div>", "<section><div>{}</div></section>"])
        rows.append((i, h, f"<html><body><div class=q>{LONG * rnd.randrange(3)}</div>{box.format(body)}<footer>f</footer>"))
    return rows + [rows[0], (None, "http://hot.example.com/", rows[1][2]), (900, "http://hot.example.com/", None), (901, None, "")]


def _brute(rows):
    def host(u):
        m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", u or "")
        return m and m[1].lower()
    cast = defaultdict(lambda: defaultdict(list))
    for _, u, s in rows:
        if host(u):
            for p, v in X.votes(X.read(s)).items():
                cast[host(u)][p].append(v)
    won = {h: sorted(c, key=lambda p: (-(sum(c[p]) // (len(c[p]) + 1)), -p.count(">"), p))[:8] for h, c in cast.items()}
    out = [(i, u, X.extract(X.read(s), won.get(host(u)))) for i, u, s in rows]
    return sorted(((*r, len(r[2])) for r in out), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "salts": 1}])
def test_extract_pages(spark, sizes):
    rows = _pages()
    got = X.extract_pages(spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(3), **sizes)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(rows)


def test_empty_table(spark):
    assert X.extract_pages(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("source", ["<div>" * 60_000 + "x" + "</div>" * 60_000, "<p><b>" * 60_000, '<a href="x' * 40_000, "<" * 200_000, "<!--" * 60_000, "</span>" * 100_000,
                                    "<script>" * 60_000, "&amp" * 100_000, "<td>" * 60_000, "<a title='" * 60_000 + ">", f"<article><p>{'word ' * 400_000}</p></article>"])
def test_time_is_linear(source):
    start = time.time()
    X.extract(X.read(source), None)
    X.votes(X.read(source))
    assert time.time() - start < 12
