import difflib
import html

import pytest
from pyspark.sql import functions as F

from rosterforge.functions import evidence, kernels
from rosterforge.functions import html as H
from rosterforge.functions import text as T
from rosterforge.functions import urls as U


@pytest.fixture(scope="module")
def run(spark):
    def apply(f, *values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]

    return apply


def test_names(run):
    assert run(T.name_key, "PancakeSwap AMM", "Thala LSD", "Aptin Finance V2", "Swap", "Thala Labs Finance", None) == ["pancake", "thala", "aptin", "", "thala", ""]
    assert run(T.search_term, "Ref Finance DEX", " Flux Protocol ", "V2 V2", "AB DEX", "A Finance V2") == ["Ref Finance", "Flux", "V2 V2", "AB DEX", "A Finance"]
    assert run(T.coin_key, "Ref Finance", "finance", "My-Coin Labs") == ["ref", "finance", "my coin"]
    assert run(T.chain_slug, " The BIG Chain! ") == ["the-big-chain"]
    assert run(T.title, "liquid-staking dexes", "a1b") == ["Liquid-Staking Dexes", "A1B"]
    assert run(T.status_text, "✅ Active", "Live") == ["Active", "Live"]


def test_cells(run):
    assert run(T.sanitized, "a,\r\nb &amp; c", "&amp;lt;", None) == ["a; b & c", "<", ""]
    assert run(T.clean_note, "DEX from NEARCatalog - Great 🚀 swap! | Grid confirms: USDT", "X from AwesomeNEAR", " - hi, | b ", "") == ["Great swap! | Grid confirms: USDT", "", "hi | b", ""]
    assert run(T.usd, 217796.5, 2.5, kind="double") == ["$217,796", "$2"]
    slugs = lambda c: F.array_join(T.slug_candidates(c, F.lit("ref.finance")), " ")
    assert run(slugs, "Ref Finance") == ["ref_finance ref-finance ref"]
    words = lambda c: F.array_join(T.coin_keywords(F.split(c, ",")[0], F.split(c, ",")[1]), " ")
    assert run(words, "DAI,Dai", "TUSD,TrueUSD", "X,Xy") == ["dai", "tusd trueusd", ""]
    assert run(lambda c: T.distinct_ci(F.split(c, ";")), "a;B;A;b;c") == [["a", "B", "c"]]


def test_urls(run):
    assert run(U.url_key, "https://www.Aave.com/", "https://aave.com/?utm=1", "") == ["aave.com", "aave.com/", ""]
    assert run(U.domain, "https://www.aurora.dev/", "Aurora.dev:80/x", "http://a.b c/", "") == ["aurora.dev", "aurora.dev", "a.b c", ""]
    assert run(U.registry_domain, "ftp://www.x.www.com:8/a") == ["x.com:8"]
    assert run(U.is_fetchable, "a.com", "http://localhost/x", "10.0.0.1", "ftp://a.com", "", "https://a.com:8/x") == [True, False, False, False, False, True]
    assert run(U.handle, "https://twitter.com/Near/", "X", "@a?b", "") == ["@Near", "@X", "@a", ""]
    assert run(U.profile_link, "@near", "") == ["https://x.com/near", ""]
    assert run(lambda c: U.root_id(F.lit(""), c), "https://admin.thegrid.id/?x=1&rootId=id%31", "https://a.com/?rootId=2") == ["id1", ""]
    assert run(lambda c: U.app_store(c)["id"], "https://play.google.com/store/apps/details?id=a.b&hl=x", "https://apps.apple.com/us/app/x/id12", "https://a.com") == ["a.b", "12", None]
    assert run(U.without_tracking, "https://a.com/?utm_source=x&b=1&utm_y=2#f", "https://a.com/?utm_a=1") == ["https://a.com/?b=1#f", "https://a.com/"]
    rules = [("https://*.a.com/**", "sub"), ("https://a.com/*", "top")]
    assert run(lambda c: U.route(c, rules, "generic"), "https://x.a.com/b/c", "https://a.com/b", "https://a.com/b/c") == ["sub", "top", "generic"]


def test_resolved_links_are_the_standards(run):
    from urllib.parse import urljoin

    base = "https://a.com/b/c/d?q=1#f"
    hrefs = ["/x", "x", "../x", "//h.org/x", "https://z.io/p", "?y=2", "./x/../y/", "..", "x?a=b#c", "../../../x"]
    assert run(lambda c: U.resolved(F.lit(base), c), *hrefs) == [urljoin(base, h) for h in hrefs]


def test_html(run):
    page = '<html><head><meta property="og:description" content="A page about many things."><script>var x = "</p>";</script></head><body>Hi&nbsp;<b>you</b> &eacute;&amp;</body>'
    assert run(H.page_text, page) == ["hi you é&"]
    assert run(H.description, page, '<meta content="short" name="description">', '<script type="application/ld+json">{"description": "from structured data, long"}</script>') == ["A page about many things.", "", "from structured data, long"]
    unclosed = lambda c: H.page_text(c, unclosed=False)
    assert run(unclosed, "<p>a&amp b&&amp;amp; &copy; &notit; &#38; &#x27; &amp", "<p>&amp x") == ["a&amp b&&amp; © &notit; & ' &amp", "&amp x"]
    assert run(kernels.unescaped, "&notit; &#x27;") == [html.unescape("&notit; &#x27;")]
    pairs = ["tide,diet", "diet,tide", "abcd,abcd", ","]
    got = run(lambda c: kernels.ratio(F.split(c, ",")[0], F.split(c, ",")[1]), *pairs)
    assert got == [difflib.SequenceMatcher(None, *p.split(",")).ratio() for p in pairs]


def test_segments(run):
    cell = "USDT: $217;797 | SOL: deployed on solana (CoinGecko) | Grid: X (product) | website-scan: scanned"
    kinds = lambda c: F.transform(evidence.parsed(c), lambda s: s["kind"])
    assert run(kinds, cell) == [["defillama", "coingecko", "grid", "website"]]
    assert run(lambda c: evidence.rendered(evidence.segments(c)), cell) == [cell]
    told = lambda c: evidence.with_health(c, F.lit("dead"), F.lit(404))
    assert run(told, "a | health-check: alive (200) | b", "") == ["a | b | health-check: dead (404)", "health-check: dead (404)"]
    note = lambda c: evidence.with_health_note(c, F.lit(False), F.lit("x"))
    assert run(note, "a | [website-health] DEAD: gone", "[website-health] DEAD: gone | b") == ["a", "b"]
