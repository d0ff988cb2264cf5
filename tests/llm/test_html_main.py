import html
import re
from collections import Counter

import duckdb
from llm_fixtures import plain

from erpspark.llm import catalog, html_main

DATA = "/root/testdata/sf0.01"
DDL = "page_id long, url string, html string, host string, page long"


def expected(page):
    """The article of the generated pages, read with plain patterns."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)
    parts = re.split(r"<(?:/?p|/?h1|br)\b[^>]*>", body[1])
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
    return "\n".join(t for t in texts if t)


def test_data(spark):
    pages = {i: h for i, h in duckdb.sql(f"select page_id, html from '{DATA}/pages.parquet'").fetchall()}
    got = catalog.QUERIES["op10_main_text"](spark, DATA).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == expected(pages[r.page_id]) and r.n_chars == len(r.text)


def run(spark, rows):
    out = html_main.extract(plain(spark, [(*r, "clash", 7) for r in rows], DDL))
    return out.select("page_id", "__text", "__n_chars").collect()


def test_template_of_a_host(spark):
    box = "<div><span>Follow  us</span> every day</div>"
    pages = [(i, f"http://a.example.com/{i}", f"<body>{box}<p>Own text {i}.</p><p>Shared words</p></body>") for i in range(9)]
    other = [(100, "http://b.example.com/1", f"<body>{box}<p>Own text.</p></body>"), (101, None, f"<body>{box}</body>")]
    inside = [(200 + i, "http://c.example.com", f"<article><p>Licence line</p><p>t{i}</p></article>{box}") for i in range(9)]
    got = {r.page_id: r.__text if hasattr(r, "__text") else r["__text"] for r in run(spark, pages + other + inside)}
    assert all(got[i] == f"Own text {i}." for i in range(9))
    assert got[100] == "Follow us every day\nOwn text." and got[101] == "Follow us every day"
    assert all(got[200 + i] == f"Licence line\nt{i}" for i in range(9))


def test_edges(spark):
    cases = [
        (None, ""), ("", ""), ("plain &amp; text\n\n here", "plain & text here"), ("<p>a<p>b<div>c</div>d", "a\nb\nc\nd"),
        ("<article><h1>T</h1><p><b>x<br>y</b> z<aside>no</aside><form>f</form></p><div class='comments'><p>c</p></div></article><footer>f", "T\nx y z"),
        ("<script>var a='<p>no</p>'</script><p>yes &lt;b&gt; &#233;&nbsp;!</p>", "yes <b> é !"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<p>cut off <a href='x", "cut off"),
        ("<!-- <p>no</p> --><header>h</header><main><header>Title</header><p>m</p></main>", "Title\nm"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<style>p{}", ""),
        ("<div id=cookie-notice>c</div><table><tr><td>1<td>2</table>", "1\n2"), ("<p>" + "word " * 40_000, " ".join(["word"] * 40_000)), ("</p></div><i>e</i>", "e"),
    ]
    rows = [(i, "u", page) for i, (page, _) in enumerate(cases)] + [(None, None, None), (3, "u", cases[3][0])]
    got = run(spark, rows)
    assert Counter((r.page_id, r["__text"]) for r in got) == Counter([(i, t) for i, (_, t) in enumerate(cases)] + [(None, ""), (3, cases[3][1])])
    assert all(r["__n_chars"] == len(r["__text"]) for r in got)
    assert run(spark, []) == []


def texts(spark, rows):
    return {r.page_id: r["__text"] for r in run(spark, rows)}


def test_counting_inside_and_beside_articles(spark):
    box = "<div class='x1'><p>Tell your friends</p></div>"
    boxed = [(i, "http://a.example.com", f"<article><p>Licence line</p><p>Own {i}</p>{box}</article>") for i in range(9)]
    few = [(20 + i, "http://b.example.com", f"<article><p>Own {i}</p>{box}</article>") for i in range(7)]
    beside = [(40, "http://c.example.com", "<article><p>Teaser</p></article><div><p>Main text of the page</p></div>")]
    got = texts(spark, boxed + few + beside)
    assert all(got[i] == f"Licence line\nOwn {i}" for i in range(9))
    assert all(got[20 + i] == f"Own {i}\nTell your friends" for i in range(7))
    assert got[40] == "Teaser\nMain text of the page"


def test_copies_are_no_template(spark):
    body = "<div><p>Syndicated text</p><p>goes on</p></div>"
    same = [(i, f"http://a.example.com/{i}", f"<body><div class='ad'>Buy {i}</div>{body}</body>") for i in range(30)]
    article = [(100 + i, f"http://b.example.com/{i}", f"<article><h1>T</h1>{body}</article><p>Related {i}</p>") for i in range(30)]
    # on a large host a rare variant is as much template as on a small one
    box = "<div><span>Follow us</span></div>"
    large = [(200 + i, "http://c.example.com", f"<p>Text {i}</p>{box if i < 8 else ''}") for i in range(1200)]
    got = texts(spark, same + article + large)
    assert all(got[i] == "Syndicated text\ngoes on" for i in range(30))
    assert all(got[100 + i] == f"T\nSyndicated text\ngoes on\nRelated {i}" for i in range(30))
    assert all(got[200 + i] == f"Text {i}" for i in range(1200))


def test_marking_words_inside_articles(spark):
    page = """<article><section id="search-trees"><p>Search trees</p></section><h2 id="comments-on-method">On method</h2><h2 id="comments">Comments</h2>
    <div class="elementor-widget-text"><p>Passage</p></div><div class="comments"><p>c</p></div></article>"""
    nested = "<main><article class='elementor-widget post'><p>Post</p></article><article class='comment'><p>c</p></article></main>"
    shared = [(10 + i, "http://b.example.com", f"<article><p>Own {i}</p><p class='share-this'>Share this</p></article>") for i in range(9)]
    got = texts(spark, [(1, "http://a.example.com", page), (2, "http://a.example.com", nested), *shared])
    assert got[1] == "Search trees\nOn method\nComments\nPassage" and got[2] == "Post"
    assert all(got[10 + i] == f"Own {i}" for i in range(9))
