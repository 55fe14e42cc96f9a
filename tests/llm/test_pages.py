"""Main text of pages: layouts, templates without telling names, odd markup."""

import html
import re

import pyarrow.dataset as ds

from panelwright.llm import pages as p

SF_DIR = "/root/testdata/sf0.001"


def text_of(source, deleted=()):
    return p.Page(source, "h").text(set(deleted))


def extracted(spark, rows):
    found = p.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    out = sorted((tuple(r) for r in found.collect()), key=repr)
    assert all(r[3] == len(r[2]) for r in out)
    return out


def test_registered_query_against_a_plain_reading(spark):
    from panelwright.llm import queries

    want = {}
    for r in ds.dataset(f"{SF_DIR}/pages.parquet").to_table().to_pylist():  # these pages have articles of h1, p, b and br alone
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r["html"], re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want[r["page_id"]] = "\n".join(b for b in blocks if b)
    found = queries.queries()["op11_main_text"](spark, SF_DIR).collect()
    assert len(found) == len(want) and {r["page_id"]: r["text"] for r in found} == want and all(r["n_chars"] == len(r["text"]) for r in found)


def test_layouts():
    assert text_of("<header>Site</header><nav>Menu</nav><main><h1>T &amp; U</h1><p>One\n two<p>Three<br>four</main><aside>x</aside><footer>f</footer>") == "T & U\nOne two\nThree four"
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
      <div id="top-menu"><a href="/">Home</a></div><div class="cookie-notice">We use cookies</div>
      <form><div class="page"><article><header><h1>Head</h1></header><p>First <b>bold <i>text</b> here.</p>
      <div class="ad-slot">Buy!</div><script>if (a < b) document.write("<p>no</p>")</script><!-- <p>not</p> -->
      <ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><th>3</table><div class="shareButtons">Share</div>
      <form>mail <input></form><section id="comments"><article class="comment">Reader</article></section></article></div></form>
      <div class="sidebar">Links</div><div hidden>unseen</div></body></html>"""
    assert text_of(page) == "Head\nFirst bold text here.\na\nb\n1 2\n3"
    assert text_of("<div class='post-content'><h2>A</h2><div>B</div> C</div><div class='widget'>no</div>") == "A\nB\nC"
    assert text_of("plain &lt;text&gt; &#8364;&eacute;&amp and a < b > c <3") == "plain <text> €é& and a < b > c <3"


def test_odd_markup():
    for source, want in (("", ""), ("<", "<"), ("<p", "<p"), ("<p>a", "a"), ("a</p></div>b", "ab"), ("<p title='>'>x</p>", "x"), ('<p title="a>x</p>', "x"), ("<script>never closed <p>x", ""), ("a<!-- open", "a"), ("<![CDATA[x]]>y", "y"), ("<P CLASS=AD>x</P>y", "y"), ("a  b", "a b")):
        assert text_of(source) == want, source
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert text_of(deep) == "x" and text_of("<b>" * 20_000 + "x") == "x"
    long = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    assert text_of(long).count("\n") == 49_999


def site(n, host="h.org", banner="<div class='zz'><span>Buy the paper</span> today</div>", first=0):
    return [(first + i, f"https://{host}/{i}", f"{banner}<div class='q'><p>Own words of page {i}, and more of {i}.</p><p>Often quoted.</p></div>") for i in range(n)]


def test_recurring_subtrees_go(spark, monkeypatch):
    rows = site(4) + site(2, "few.org", first=100) + [(200, None, "<div>Buy the paper</div>x"), (201, "https://h.org/n", None), (None, "https://h.org/0", "<p>x</p>"), (202, "https://e.org/", "")]
    rows += [(300, "https://h.org/c", rows[0][2]), (300, "https://h.org/c", rows[0][2])]
    want = sorted(
        [(i, u, f"Own words of page {i}, and more of {i}.\nOften quoted.") for i, u, _ in rows[:4]]
        + [(100 + i, f"https://few.org/{i}", f"Buy the paper today\nOwn words of page {i}, and more of {i}.\nOften quoted.") for i in range(2)]
        + [(200, None, "Buy the paper\nx"), (201, "https://h.org/n", ""), (None, "https://h.org/0", "x"), (202, "https://e.org/", "")]
        + [(300, "https://h.org/c", "Own words of page 0, and more of 0.\nOften quoted.")] * 2,
        key=repr,
    )
    for bound in (p.SENT_HASHES, 0):  # sent to the tasks, and joined
        monkeypatch.setattr(p, "SENT_HASHES", bound)
        assert [r[:3] for r in extracted(spark, rows)] == sorted(want, key=repr)


def test_copies_of_an_article_are_no_template(spark):
    body = "<article><h1>Same</h1><p>Copied paragraph.</p><div>Boxed.</div></article>"
    rows = [(i, "http://h.org/", f"<ul><li>menu {i}</li></ul>{body}") for i in range(40)]
    rows += [(100 + i, "http://h.org/", f"<div class='m'>Follow us</div><article><p>Quoted passage.</p><p>Page {i}.</p><div class='box'>Read on</div></article>") for i in range(30)]
    found = {r[0]: r[2] for r in extracted(spark, rows)}
    assert all(found[i] == "Same\nCopied paragraph.\nBoxed." for i in range(40))
    # within an article, what more than half of the host's distinct pages have is a template
    assert all(found[100 + i] == f"Page {i}." for i in range(30))


def test_empty_table_and_other_columns(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, text int, host string, page int, deleted int")
    assert p.main_text(none).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/", "<p>x</p>", 5, "z", 3, 4)], none.schema)
    assert [tuple(r) for r in p.main_text(one).collect()] == [(1, "http://a.b/", "x", 1)]
