"""Page content, link forms and URL rules on hand-written pages and sf0.001."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.functions import htmlparse as hp
from lodestar.operators import html as H
from lodestar.sources.tables import read_table

PAGE = """<html><head><meta property="og:title" content="OG T"><script>var x="</p>";</script></head><body>
<nav><a href="/nav">n</a></nav>
<div class="list"><a href="/a1"><h3>One</h3></a><a href="/a2">plain</a></div>
<article class="l-post"><h2><a href="/deep">Deep</a></h2></article>
<main><h1>  Main  Title </h1><div class="entry-content"><p>Body &amp; text</p><div class="ad">buy</div>
<script>bad()</script><p>more</p></div></main></body></html>"""


def test_parser_title_content_links():
    page = hp.Page(PAGE)
    assert hp.page_title(page, H.TITLE_SELECTORS) == "Main  Title"
    content = hp.main_content(page, ["div.entry-content"], H.STRIP_SELECTORS, H.FALLBACK_SELECTORS, H.FALLBACK_STRIP)
    assert "Body &amp; text" in content and "more" in content
    assert "buy" not in content and "bad()" not in content
    assert hp.heading_links(page, "h3") == ["/a1"]
    assert hp.links_under(page, "article.l-post h2") == ["/deep"]
    assert hp.page_title(hp.Page("<p>x</p>"), ["h1"]) is None
    assert hp.page_title(hp.Page('<meta property="og:title" content=" T ">'), ["h1"]) == "T"


def test_selector_links_match_regex_form(spark):
    p = read_table(spark, SF_SMALL, "pages", ["page_id", "url", "html"])
    a = sorted(tuple(r) for r in H.selector_links(p, H.site_profiles(p)).collect())
    b = sorted(tuple(r) for r in H.extract_links(p).select("page_id", "position", "href").collect())
    assert a == b


def test_selector_rules(spark):
    pages = spark.createDataFrame([(1, "https://s.example.org/x", PAGE)], "page_id long, url string, html string")
    prof = spark.createDataFrame([("s.example.org", "heading_link", "h3")], "source_site string, link_rule string, link_arg string")
    assert [r.href for r in H.selector_links(pages, prof).collect()] == ["/a1"]
    prof2 = spark.createDataFrame([("s.example.org", "under", "article.l-post h2")], "source_site string, link_rule string, link_arg string")
    assert [r.href for r in H.selector_links(pages, prof2).collect()] == ["/deep"]


def test_url_rules(spark):
    df = spark.createDataFrame([("http://h.org/p?page=2&ref=x#top",), ("http://h.org/p?ref=x&a=1",), ("http://h.org/p?ref=x",),
                                ("https://h.org/2024/01/02/slug/",), ("https://h.org/123/slug",), ("https://h.org/tag",)], "u string")
    out = df.select(H.canonical_drop_ref("u").alias("r"), H.canonical_drop_query("u").alias("q"),
                    H.detail_date_path("u").alias("d"), H.detail_numeric_path("u").alias("n"),
                    H.detail_single_segment("u").alias("s")).collect()
    assert [r.r for r in out[:3]] == ["http://h.org/p?page=2#top", "http://h.org/p?a=1", "http://h.org/p"]
    assert out[0].q == "http://h.org/p#top"
    assert out[3].d and not out[3].n and out[4].n and not out[5].s


def test_profile_driven_detail_links(spark):
    html = ('<a href="/2024/01/02/post-one/">a</a><a href="/2024/01/02/post-one/?ref=x">dup</a>'
            '<a href="/tag/">t</a><a href="https://other.org/2024/01/02/x/">o</a><a href="/123/item">n</a>')
    pages = spark.createDataFrame([(1, "https://dated.example.org/category/x/", html),
                                   (2, "https://numeric.example.org/list", html)], "page_id long, url string, html string")
    prof = spark.createDataFrame([
        ("dated.example.org", "any", None, "drop_query", "date_path"),
        ("numeric.example.org", "heading_link", "h3", "drop_ref", "numeric_path")],
        "source_site string, link_rule string, link_arg string, canonical string, detail_rule string")
    got = sorted((r.page_id, r.link, r.found) for r in H.detail_links(pages, prof).collect())
    assert got == [(1, "https://dated.example.org/2024/01/02/post-one/", 1)]
    prof2 = prof.replace("heading_link", "any", subset=["link_rule"])
    got2 = sorted((r.page_id, r.link) for r in H.detail_links(pages, prof2).collect())
    assert (2, "https://numeric.example.org/123/item") in got2


def test_resolve_url_rules():
    r = H._resolve
    assert r("https://A.Example.org/x/y", "../z") == "https://a.example.org/z"
    assert r("http://h.org:80/a", "/b c") == "http://h.org/b%20c"
    assert r("https://h.org", "") == "https://h.org/"
    assert r("https://h.org/p", "?q=1#top") == "https://h.org/p?q=1#top"
    assert r("https://h.org/p", "mailto:x@y.org") is None
    assert r("https://h.org/p", "http://bad host/") is None
    assert r("https://h.org/p", "https://h.org:99999/") is None
    assert r("https://h.org/p", "/é") == "https://h.org/%C3%A9"


def test_selector_group_takes_first_in_document_order():
    page = hp.Page('<article><h2>First</h2></article><h2 class="entry-title">Second</h2>')
    assert hp.page_title(page, ["h1", "h2.entry-title, h2.post-title, article h2"]) == "First"
    assert hp.page_title(page, ["h1", "h2.entry-title"]) == "Second"


def test_scrape_stats_status_rule(spark):
    body = "<article><h1>Title</h1><p>" + "word " * 40 + "</p></article>"
    rows = [(1, "https://ok.example.org/a", body), (2, "https://ok.example.org/b", body),
            (3, "https://mixed.example.org/a", body), (4, "https://mixed.example.org/b", ""),
            (5, "https://down.example.org/a", None), (6, "https://down.example.org/b", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    st = {r.source_site: (r.scraped, r.errors, r.status) for r in H.scrape_stats(pages).collect()}
    assert st["ok.example.org"] == (2, 0, "success")
    assert st["mixed.example.org"] == (1, 1, "partial")
    assert st["down.example.org"] == (0, 2, "failed")


def test_selector_engine():
    page = hp.Page('<nav><ul class="nope"><li>n</li></ul></nav><div><ul class="nope"><li>d</li></ul></div>'
                   '<div class="entry-content scholarship-item"><h2>Name</h2>text</div><div class="entry-content">x</div>')
    assert [page.text(i) for i in page.select("nav ul.nope li")] == ["n"]
    assert [page.text(i) for i in page.select("div.entry-content.scholarship-item")] == ["Nametext"]
    assert hp.page_title(page, ["h2", "h1"], "div.entry-content.scholarship-item") == "Name"


def test_native_links_equal_the_parser(spark):
    html = ('<a data-href="/no" href="/good?a=1&amp;b=2">x</a><!-- <a href="/commented">c</a> --><a href=/unq>u</a>'
            "<script>var s='<a href=\"/script\">';</script><A class=k HREF = '/single'>s</A><a>none</a><area href='/area'><abbr href=\"/b\">")
    pages = spark.createDataFrame([(1, "https://h.org/", html)], "page_id long, url string, html string")
    got = [r.href for r in H.extract_links(pages).orderBy("position").collect()]
    assert got == ["/good?a=1&b=2", "/unq", "/single"] == hp.all_links(hp.Page(html))


def test_every_ref_is_dropped_and_the_fragment_kept(spark):
    urls = ["http://h/p?ref=a&ref=b&x=1", "http://h/p?ref", "http://h/p#a&ref=b", "http://h/p?xref=1&ref=2#f?ref=3", "http://h/p?a=1"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(H.canonical_drop_ref("u").alias("r"))
    assert [r.r for r in df.collect()] == ["http://h/p?x=1", "http://h/p", "http://h/p#a&ref=b", "http://h/p?xref=1#f?ref=3", "http://h/p?a=1"]


def test_excluded_prefixes_are_prefixes(spark):
    df = spark.createDataFrame([("https://h.org/about-us",), ("https://h.org/grant-2026",), ("https://h.org/2024/01/02/s/?x=1",)], "u string")
    r = df.select(H.detail_single_segment("u").alias("s"), H.detail_date_path("u").alias("d")).collect()
    assert [x.s for x in r[:2]] == [False, True] and not r[2].d


def test_found_is_counted_before_the_cap(spark):
    html = "".join(f'<a href="/post-{i}">p</a>' for i in range(60))
    pages = spark.createDataFrame([(1, "https://s.org/category/x/", html), (2, "https://s.org/category/y/", html[:200])], "page_id long, url string, html string")
    links = H.detail_links(pages)
    assert links.where("page_id = 1").count() == 50 and links.where("page_id = 1").first().found == 60
    extra = links.where("page_id = 2").first().found
    assert H.scrape_stats(pages).first().found == 60 + extra
    prof = spark.createDataFrame([("s.org", 7)], "source_site string, max_links int")
    assert H.detail_links(pages, prof).where("page_id = 1").count() == 7


def test_broken_markup_is_an_error_of_its_page(monkeypatch):
    def broken(self, data):
        self.handle_starttag("h1", [])
        raise AssertionError("bad markup")
    monkeypatch.setattr(hp._Index, "feed", broken)
    page = hp.Page("<h1>t</h1>")
    assert page.error == "AssertionError: bad markup" and hp.Page("x").select("h1") == [0]


def test_profiles_of_five_kinds_of_site(spark):
    """Seeds, link forms, canonical forms, detail rules and titles are rows of data."""
    names = ("source_site string, base_url string, domain string, categories array<string>, index_pages int, page_form string, link_rule string, "
             "link_arg string, canonical string, detail_rule string, title_scope string, title_selectors array<string>, content_selectors array<string>")
    prof = spark.createDataFrame([
        ("www.a.org", "https://www.a.org", "a.org", ["/browse"], 3, "plain", "heading_link", "h3", "drop_ref", "any", None, ["h1"], [".post"]),
        ("b.org", "https://b.org", "b.org", ["/", "/x/"], 5, "folder", "any", None, "trailing_slash", "date_path", None, ["h1"], [".post"]),
        ("c.org", "https://c.org", "c.org", ["/category/g/", "/category/f/"], 4, "folder", "under", "article.l-post h2", "drop_query", "any", None, ["h1"], [".post"]),
        ("d.org", "https://d.org", "d.org", ["/grants/", "/jobs/"], 4, "folder", "any", None, "trailing_slash", "numeric_path", None, ["h1"], [".post"]),
        ("e.org", "https://e.org", "e.org", ["/latest"], 2, "query", "under", "div.card h5.title", "drop_query", "single_segment", "div.entry.item", ["h2", "h1"], ["div.entry.item"])],
        names)
    seeds = {}
    for r in H.seed_urls(prof).orderBy("source_site", "cat_pos", "page_no").collect():
        seeds.setdefault(r.source_site, []).append(r.url)
    assert sum(map(len, seeds.values())) == 31
    assert seeds["www.a.org"] == ["https://www.a.org/browse", "https://www.a.org/browse/page/2", "https://www.a.org/browse/page/3"]
    assert seeds["b.org"][:2] == ["https://b.org/", "https://b.org/page/2/"] and seeds["e.org"] == ["https://e.org/latest", "https://e.org/latest?page=2"]
    html = ('<a href="https://a.org/o?ref=browse&k=1"><h3>t</h3></a><a href="/2024/01/02/slug">s</a><article class="l-post big"><h2><a href="/deep?utm=1">d</a></h2></article>'
            '<a href="/77/item">n</a><div class="card x"><h5 class="title"><a href="/one-2026?u=1">c</a><a href="/about-us">a</a></h5></div>')
    pages = spark.createDataFrame([(i, f"https://{h}/index", html) for i, h in enumerate(["www.a.org", "b.org", "c.org", "d.org", "e.org"])],
                                  "page_id long, url string, html string")
    got = {}
    for r in H.detail_links(pages, prof).collect():
        got.setdefault(r.page_id, []).append(r.link)
    assert got == {0: ["https://a.org/o?k=1"], 1: ["https://b.org/2024/01/02/slug/"], 2: ["https://c.org/deep"],
                   3: ["https://d.org/77/item/"], 4: ["https://e.org/one-2026"]}
    body = '<h1>Head</h1><div class="item entry"><h2>Scoped</h2><nav>n</nav>text</div>'
    c = H.page_content(spark.createDataFrame([(1, "https://e.org/x", body), (2, "https://b.org/x", body)], "page_id long, url string, html string"), prof)
    got = {r.page_id: (r.title, r.content) for r in c.collect()}
    assert got == {1: ("Scoped", "<h2>Scoped</h2>text"), 2: ("Head", None)}


def test_selectors_of_other_kinds_are_rejected():
    import pytest
    from lodestar.functions import htmlparse
    page = htmlparse.Page("<div id=a><p class='x y'>t</p></div>")
    assert page.select("div p.x.y, .x") == page.select("p")
    for bad in ("div > p", "#a", "p[class]", "div, p:first-child", "*"):
        with pytest.raises(htmlparse.UnknownSelector):
            page.select(bad)


def test_content_is_given_back_in_short_runs():
    """A worker's texts are bounded by bytes, whatever the batch holds; null pages and ids are rows."""
    import pyarrow as pa
    from lodestar.operators import html as H
    n = 40
    page = "<html><body><article><h1>t</h1>" + "x" * 300_000 + "</article></body></html>"
    texts = pa.list_(pa.string())
    lists = {"title_selectors": ["h1"], "content_selectors": ["article"], "strip_selectors": [], "fallback_selectors": ["body"], "fallback_strip": []}
    html = [page] * (n - 1) + [None]
    batch = pa.RecordBatch.from_pydict({
        "page_id": pa.array([*range(n - 1), None], pa.int64()), "url": pa.array(["u"] * n), "html": pa.array(html),
        "link_arg": pa.nulls(n, pa.string()), "title_scope": pa.nulls(n, pa.string()), **{k: pa.array([v] * n, texts) for k, v in lists.items()}})
    got = list(H._content_pass(False)(iter([batch])))
    assert len(got) > 1 and max(b.column("content").nbytes for b in got) < 2 * H.RUN_BYTES
    rows = [r for b in got for r in b.to_pylist()]
    assert [r["page_id"] for r in rows] == [*range(n - 1), None]
    assert {r["title"] for r in rows[:-1]} == {"t"} and all(len(r["content"]) > 300_000 for r in rows[:-1]) and rows[-1]["title"] is None
