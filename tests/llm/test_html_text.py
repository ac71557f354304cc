"""HTML extraction: pages whose article is known, site templates, broken markup and edge cases."""

from __future__ import annotations

import html
import random

import pytest

from roomgrid.llm import html_text as H

SCHEMA = "page_id long, url string, html string, text string, host string, template string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def _text(source, template=frozenset()):
    return H.Page(source).text(template)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>no";</script></head><body>
<header><h1>Site name</h1><form><input>find</form></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
<div id="sidebar"><p>Popular</p></div><div class="ad">Buy now</div><article><header><h1>Title</h1></header>{body}
<div class="share">Share this</div><aside>See also</aside><form>Leave a reply<textarea>x</textarea></form>
<section id="comments"><h2>Comments</h2><article class="comment"><p>First!</p></article></section></article>
<section class="related-posts">More</section><footer>&copy; 2024 host &middot; imprint</footer></body></html>"""


@pytest.mark.parametrize(
    "body, want",
    [
        ("<p>one</p><p>two</p>", "Title one two"),
        ("<p>one<p>two<br>three<ul><li>a<li>b</ul>", "Title one two three a b"),
        ("<p><b>bo</b>ld <i>x</i>, <a href='a>b'>link</a></p>", "Title bold x, link"),
        ("<p>a &amp;lt; b &lt;p&gt; &#233;&#x4e2d; &copy;</p>", "Title a &lt; b <p> é中 ©"),
        ("<p>un\n  even \t white   space</p>", "Title un even white space"),
        ("<p>3 < 4 and 5 > 2 <- x</p>", "Title 3 < 4 and 5 > 2 <- x"),
        ("<!-- <p>gone</p> --><p>kept</p><script>if (a</b/.test(x)) '<p>no</p>'</script><noscript>no</noscript>", "Title kept"),
        ("<table><tr><td>1<td>2<tr><td>3</table><pre>a\n b</pre><blockquote>q</blockquote>", "Title 1 2 3 a b q"),
        ("<div><section><p>deep</p></section></div></div></span>", "Title deep"),
        ("<P CLASS=x>upper</P><p style='display: none'>hidden</p><p hidden>h</p>", "Title upper"),
        ("", "Title"),
    ],
)
def test_articles(body, want):
    assert _text(PAGE.format(body=body)) == want


@pytest.mark.parametrize(
    "source, want",
    [
        (None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a b"), ("<nav>menu</nav>", ""), ("<", "<"), ("<a href=\"x>never closed", '<a href="x>never closed'),
        ("<script>never closed <p>x</p>", ""), ("<!-- never closed <p>x", ""), ("<main><p>m</p></main><p>outside</p>", "m"), ("<div role=main>m</div><p>o</p>", "m"),
        ("<div class='post-content'><p>c</p></div><div>o</div>", "c"), ("<body><p>x</p><footer>f</footer>", "x"), ("<div>" * 20_000 + "deep" + "</div>" * 20_000, "deep"),
        ("</p></div></article>x", "x"), ("<article></article><p>rest</p>", "rest"),
    ],
)
def test_edges(source, want):
    assert _text(source) == want


def test_white_space_and_length():
    long = "<article>" + "".join(f"<p>w{i} {'x' * (i % 7)}</p>" for i in range(30_000)) + "</article>"
    assert _text(long).split() == [w for i in range(30_000) for w in (f"w{i}", "x" * (i % 7)) if w]


def _site(rng, i):
    own = [" ".join(rng.choice(["river", "stone", "night", "glass", "wind"]) + str(rng.randint(0, 999)) for _ in range(25)) for _ in range(4)]
    shared = "A paragraph that articles of this site quote from each other now and then."
    paragraphs = [*own, shared] if i % 2 else own
    widget = "<div><span>Was this page any good?</span> <b>yes</b> <b>no</b></div>"
    top = f"<div><p>Welcome to our site</p><p>Today: sunny</p></div><table><tr><td>Contact<td>Imprint</table><div><i>{rng.choice('abc')}</i></div>"
    body = "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs)
    return paragraphs, top, widget, body


@pytest.mark.parametrize("broadcast_rows", [H.BROADCAST_ROWS, 0])
def test_templates_without_names(spark, broadcast_rows):
    """Pages of one host share parts that no tag or class gives away."""
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(40):
        paragraphs, top, widget, body = _site(rng, i)
        article = i % 4 != 0
        rows.append((i, f"https://Shop.example.org:80/{i}", f"<body>{top}<article>{body}{widget}</article>{top}</body>" if article else f"<body>{top}{body}{widget}</body>"))
        want[i] = " ".join(p for p in paragraphs if article or "quote" not in p)
    # the same parts once on another host stay
    paragraphs, top, widget, body = _site(rng, 1)
    rows.append((100, "http://other.example.org/", f"<body>{body}{widget}</body>"))
    want[100] = " ".join(paragraphs) + " Was this page any good? yes no"
    got = {r["page_id"]: r for r in H.extract(_frame(spark, rows), broadcast_rows=broadcast_rows).collect()}
    drop = lambda t: " ".join(w for w in t.split() if w not in "abc")
    assert {k: drop(r["text"]) for k, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_copies_are_not_a_template(spark):
    rows = [(i, "http://h/x", "<body><div><p>an article of its own</p></div></body>") for i in range(30)]
    rows += [(None, None, None), (5, "http://h/x", ""), (6, "not a url", "<p>x</p>")]
    got = H.extract(_frame(spark, rows)).collect()
    assert len(got) == 33 and sum(r["text"] == "an article of its own" for r in got) == 30
    assert H.extract(_frame(spark, [])).count() == 0


def test_query_on_the_pages(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = H.op4_html_extraction(spark, folder).collect()
    assert {r["page_id"] for r in got} == set(rows) and len(got) == len(rows)
    for r in got:
        article = rows[r["page_id"]].split("<article>")[1].split("</article>")[0]
        for tag in ("p", "/p", "br", "h1", "/h1"):
            article = article.replace(f"<{tag}>", " ")
        assert r["text"] == " ".join(html.unescape(article.replace("<b>", "").replace("</b>", "")).split())
