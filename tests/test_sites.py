import pytest
from pyspark.sql import functions as F

from rosterforge.operators import sites as S

SHOP = S.Site(
    "shop",
    ("https://shop.example/**", "https://*.shop.example/**"),
    kinds=((r"/item/[^/]+$", "detail"), ("^/all", "list")),
    default="none",
    chain=("^/on/([^/]+)/", "/in/([^/]+)"),
    fields=(
        S.Field("slug", "/item/([^/]+)$", "url"),
        S.Field("name", "h1"),
        S.Field("description", "p, div[class*=text]", least=10, most=20),
        S.Field("category", '[class*="badge"], [class*="tag"]', first_word=True),
        S.Field("website", 'a[target="_blank"][href^="http"]:not([href*="shop.example"]):not([href*="x.com"])', "href"),
    ),
    links=S.Links("/item/([^/?#]+)", "stripTicker", most=12, fixed={"category": "fixed", "source": "shop"}, more={"url": "https://shop.example/item/{slug}", "category": "of {slug}"}),
)
WIKI = S.Site("wiki", ("*://wiki.example/*",), fields=(S.Field("name", "title", first_word=True), S.Field("chain", "img[alt], span[title]", every=True)), social=False, links=S.Links("^#(.+)$", distinct=False))


def pages(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")


def test_patterns():
    import re

    p = re.compile(S.element_pattern('a[target="_blank"][href*="http"]:not([href*="x.com"]), b').replace("\\s/", "\\s/"))
    assert p.search('<a href="http://x.com/q" target="_blank">no</a><a target=\'_blank\' class=c href="http://y">yes</a>')[3] == "yes"
    assert p.search("<body><b>bold</b>")[3] == "bold" and not p.search('<a target="_blank" data-href="http://z">q</a><article>')
    assert re.search(S.element_pattern("*[id$=end]"), '<x id="the-end"/>')[1] == "x"
    for bad in ("div p", ".c", "a > b", "", "a:hover"):
        with pytest.raises(ValueError):
            S.element_pattern(bad)


def test_two_sites_in_one_query(spark):
    shop = '<h1 class="t"> The <b>Name</b>\n x</h1><p>short</p><span class="my tag1">Dex  swap</span><a target="_blank" href="https://x.com/u">x</a><a href="https://w.example" target="_blank">w</a>'
    df = pages(
        spark,
        [
            ("https://shop.example/on/ne%20ar/item/s-1", shop),
            ("https://eu.shop.example/in/a/item/s-2", "<h1></h1><p>no name</p>"),
            ("http://wiki.example/a", "<title>Wiki page</title><img src='q' alt='One'><span title='Two'>x</span><img alt='One'><img src=z><a href='https://t.me/w'>t</a>"),
            ("https://other.example/item/1", shop),
            ("https://shop.example/", shop),
            ("https://shop.example/x/item/null", None),
            (None, shop),
        ],
    )
    got = {r.page_id: r for r in S.detail_fields(df, [SHOP, WIKI]).collect()}
    assert set(got) == {0, 2}
    assert (got[0].site, got[0].chain) == ("shop", "ne ar") and got[0].fields == {"slug": "s-1", "name": "The Name x", "category": "Dex", "website": "https://w.example", "twitter": "https://x.com/u"}
    assert (got[2].site, got[2].chain) == ("wiki", "One, Two") and got[2].fields == {"name": "Wiki", "chain": "One, Two"}
    text = "<h1>N n</h1><p>too short</p>"
    long = "<h1>N n</h1><p>a text that is long enough to be cut</p>"
    more = {r.page_id: r.fields for r in S.detail_fields(pages(spark, [("https://shop.example/item/a", text), ("https://shop.example/item/b", long)]), [SHOP]).collect()}
    assert more == {0: {"slug": "a", "name": "N n"}, 1: {"slug": "b", "name": "N n", "description": "a text that is long "}}


def test_lists(spark):
    shop = "".join(f"<a class='x' href='{h}'>{t}</a>" for h, t in (("/item/a?x", "Alpha ($AAA)"), ("/item/a", "again"), ("/item/b", "<b>B</b>"), ("/item/b", "Bee later"), ("/item/c", "Long name that drops"), ("/about", "About"), ("/item/d#t", " De\n ta ")))
    df = pages(spark, [("https://shop.example/all", shop), ("https://wiki.example/w", "<a href='#q'>Q1</a><a href='#q'>Q2</a>"), ("https://shop.example/all/in/k", None)])
    wiki = S.Site("wiki", WIKI.globs, default="list", links=WIKI.links)
    got = [(r.page_id, r.place, r.slug, r.name, r.fields) for r in S.list_records(df, [SHOP, wiki]).orderBy("page_id", "place").collect()]
    shopped = lambda s: {"source": "shop", "url": f"https://shop.example/item/{s}", "category": f"of {s}"}
    assert got == [(0, 0, "a", "Alpha", shopped("a")), (0, 6, "d", "De ta", shopped("d")), (1, 0, "q", "Q1", {}), (1, 1, "q", "Q2", {})]


def test_no_pages(spark):
    none = pages(spark, [("x", None)]).where("page_id < 0")
    assert S.detail_fields(none, [SHOP]).count() == S.list_records(none, [SHOP]).count() == 0
    assert S.routed(pages(spark, [("https://shop.example/all", ""), ("", "")]), [SHOP]).select("site", "kind").collect() == [("shop", "list"), (None, None)]
    assert S.detail_fields(pages(spark, [("https://shop.example/item/1", "<h1>x</h1>")]), [SHOP]).select(F.col("fields")["slug"].alias("s")).first().s == "1"
