from pilecall.llm import html_extract as H
from pilecall.llm.common import table

SF = "/root/testdata/sf0.001"
ARTICLE = "<p>One long paragraph of the article &amp; more of it, well over forty characters.</p><p>Second\n  <b>bold</b> text<br>after a break.</p>"
WANT = "One long paragraph of the article & more of it, well over forty characters.\nSecond bold text after a break."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


def rows(spark, given):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(given)], "page_id bigint, url string, html string")


def texts(spark, given):
    return {r.page_id: r.text for r in H.main_text(rows(spark, given)).collect()}


def test_everything_else_is_left_out(spark):
    junk = [
        "<nav><ul><li><a href='/a'>menu entry</a></li></ul></nav>",
        "<header>Site name</header>",
        "<!-- a comment <p>not text</p> --><script>var t = '</p><p>no</p>';</script><style>p{}</style>",
        "<div class='ad top'>Buy this now, it is cheap and very long advertising text for all.</div>",
        "<div id=sidebar><p>Side text that is long enough to count as a paragraph of text.</p></div>",
        "<div class='cookie-notice'>We use cookies.</div>",
        "<form><p>Your mail address please, to subscribe to all of our letters.</p><input></form>",
    ]
    comments = "<section class='comments'><p>First reader says something long that is not part of it.</p></section><footer>&copy; me</footer>"
    given = [("http://h.example/1", page("".join(junk) + f"<article>{ARTICLE}{comments}</article><footer>&copy;</footer>"))]
    given += [("http://h.example/2", page(f"<div class=post>{ARTICLE}</div>" + "".join(junk)))]
    given += [("http://other.example/2", page("".join(junk) + f"<main><div class='c'>{ARTICLE}</div></main>"))]
    assert texts(spark, given) == {0: WANT, 1: WANT, 2: WANT}


def test_unclosed_tags():
    assert H.text_at("<body><article><h1>Title</h1><p><b>Lead<br><p>Next<ul><li>a<li>b</ul></article><footer>x", None) == "Title\nLead\nNext\na\nb"
    assert H.text_at("<article><p>Text <!-- never closed", None) == "Text"
    assert H.text_at("plain &lt;text&gt; only", None) == "plain <text> only"
    assert H.text_at("<p>a < b and c > d</p>", None) == "a < b and c > d"


def test_host_consensus_beats_one_page(spark):
    """Where one page's largest container is another one, the host's path decides."""
    normal = page(f"<div class='story-1'>{ARTICLE}</div><div class='more'><p>Short teaser.</p></div>")
    odd = page("<div class='story-9'><p>A short story.</p></div><div class='more'><p>" + "Teasers that go on and on for long. " * 20 + "</p></div>")
    given = [(f"http://a.example/{i}", normal) for i in range(5)] + [("http://a.example/odd", odd)]
    got = texts(spark, given)
    assert got[0] == WANT and got[5] == "A short story."
    assert H.host_paths(rows(spark, given)).collect()[0].path == "body>div.story-#"


def test_table(spark):
    pages = table(spark, SF, "pages")
    got = H.main_text(pages).collect()
    assert len(got) == pages.count()
    given = {r.page_id: r.html for r in pages.collect()}
    for r in got:
        inside = given[r.page_id].split("<article>", 1)[1].split("</article>", 1)[0]
        assert r.n_chars == len(r.text)
        assert [x.strip() for x in r.text.split("\n")] == r.text.split("\n") and "" not in r.text.split("\n")
        plain = H.html.unescape(H.re.sub(r"<[^>]*>", " ", inside))
        assert r.text.split() == plain.split()


def test_odd_rows(spark):
    given = [(None, None), ("", ""), ("not a url", "<p>x</p>"), ("http://h/", "   "), ("http://h/", page(ARTICLE * 2000)), ("http://h/", page("<div>" * 3000 + "deep"))]
    df = rows(spark, given).selectExpr("*", "'x' as text", "'y' as host", "1 as path")
    got = {r.page_id: (r.text, r.n_chars) for r in H.main_text(df.union(df)).collect()}
    assert got[0] == ("", 0) and got[1] == ("", 0) and got[2] == ("x", 1) and got[3] == ("", 0)
    assert got[4][0] == "\n".join([WANT] * 2000) and got[5] == ("deep", 4)
    assert H.main_text(df.limit(0)).count() == 0
