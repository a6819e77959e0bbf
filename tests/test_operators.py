import difflib
import random

import pytest
from helpers import catalog, values
from pyspark.sql import functions as F

from rosterforge import schema as S
from rosterforge.operators import dedup, enrich, filters, mapping, match, merge, pages, registry, reports
from rosterforge.plans import pipeline
from rosterforge.sources import catalog as store


def names(seed, n):
    r = random.Random(seed)
    syllables = ["sta", "gate", "near", "ref", "lo", "pan", "ca", "ke", "x", "zu"]
    return ["".join(r.choice(syllables) for _ in range(r.randint(1, 5))) for _ in range(n)]


@pytest.mark.parametrize("threshold", [0.7, 0.8, 0.9])
def test_candidates_lose_no_pair(spark, threshold):
    left, right = set(names(1, 90)) | {"a", "ab", "x"}, set(names(2, 90)) | {"b", "ta", "x"}
    one = lambda keys, c: spark.createDataFrame([(k,) for k in keys], f"{c} string")
    got = {(r.a, r.b) for r in match.candidate_pairs(one(left, "a"), one(right, "b"), threshold).collect()}
    want = {(a, b) for a in left for b in right if a != b and (a in b or b in a or difflib.SequenceMatcher(None, a, b).ratio() > threshold)}
    assert want <= got
    with pytest.raises(ValueError):
        match.candidate_pairs(one(left, "a"), one(right, "b"), 0.6)


def plain_match(name, existing):
    """The rules told pair by pair, in row order."""
    best = (0.0, None)
    for i, other in existing:
        score = 1.0 if name == other else max(0.9 if name in other or other in name else 0, (lambda r: r if r > 0.8 else 0)(difflib.SequenceMatcher(None, name, other).ratio()))
        if score > best[0]:
            best = (score, i)
    return best


def test_best_match_is_the_plain_loops(spark):
    left, right = list(enumerate(names(3, 60))), list(enumerate(names(4, 60)))
    df = lambda rows: spark.createDataFrame(rows, "id long, name string")
    got = {r.id: (r.score, r.match_id) for r in match.best_name_match(df(left), df(right)).collect()}
    for i, n in left:
        want = plain_match(n, right)
        assert got.get(i, (0.0, None)) == pytest.approx(want) if want[1] is not None else i not in got


def test_gate_matches_stargate_and_empty_keys_match_nothing(spark):
    df = lambda rows: spark.createDataFrame(rows, "id long, name string")
    got = {r.id: (r.match_id, r.score) for r in match.best_name_match(df([(1, "Gate"), (2, "Swap"), (3, "")]), df([(7, ""), (8, "Stargate Finance"), (9, "Swap")])).collect()}
    assert got == {1: (8, 0.9)}
    got = match.best_name_match(df([(2, "Swap")]), df([(9, "Exchange")]), match_empty_key=True).collect()
    assert [(r.id, r.match_id, r.score) for r in got] == [(2, 9, 1.0)]


def test_import_matches_by_name_then_url(spark):
    old = catalog(spark, [{"name": "Ref Finance", "site": "https://ref.finance"}, {"name": "B", "site": "http://www.b.org/"}, {"name": "C", "site": "b.org"}])
    new = catalog(spark, [{"name": "REF"}, {"name": "Other", "site": "https://b.org"}, {"name": "zzz"}])
    got = {r.row_id: (r.match_id, r.method) for r in match.import_matches(new, old).collect()}
    assert got == {0: (0, "name"), 1: (2, "url"), 2: (None, "new")}


def test_discovery_is_sequential(spark):
    r = random.Random(8)
    rows = [{"name": f"n{r.randint(0, 12)}x", "site": r.choice(["", f"https://d{r.randint(0, 12)}.com"])} for _ in range(60)]
    old = catalog(spark, [{"name": "n1x", "site": "d2.com"}])
    seen_n, seen_d, want = {"n1x"}, {"d2.com"}, []
    for i, row in enumerate(rows):
        n, d = row["name"], row["site"].removeprefix("https://")
        if n not in seen_n and (not d or d not in seen_d):
            want.append(i)
            seen_n.add(n)
            seen_d |= {d} - {""}
    assert sorted(values(match.discovery_merge(catalog(spark, rows), old), S.NAME)) == want


def test_dedup_rules(spark):
    rows = [
        {"name": "Aa", "site": "x.com", "notes": "n1 | t1", "src": "S1", "cat": "c"},
        {"name": "AA Finance", "site": "x.com", "notes": "n2 | t2", "src": "S2", "usdt": "TRUE"},
        {"name": "aa", "ev": "e"},
        {"name": "Bb", "site": "x.org"},
        {"name": "bb", "site": "y.org"},
        {"name": "BB"},
        {"name": "Bb Labs"},
        {"name": ""},
        {"name": ""},
        {"name": "Swap"},
        {"name": "Exchange"},
    ]
    df = catalog(spark, rows)
    out = dedup.survivors(df)
    assert sorted(values(out, S.NAME)) == [0, 3, 4, 5, 6, 7, 8, 9, 10]
    first = out.where("row_id = 0").first()
    assert first["merged_rows"] == 3 and first[S.USDT] == "TRUE" and first[S.EVIDENCE] == "e" and first[S.CATEGORY] == "c" and first[S.SOURCE] == "S1; S2"
    assert first[S.NAME] == "AA Finance" and first[S.NOTES] == "n2 | t2 | t1 | (fuzzy dedup: merged from Aa; AA Finance; aa | sources: S1; S2)"
    assert tuple(dedup.counters(df).first()) == (11, 9, 0, 2)
    again = dedup.survivors(out.drop("merged_rows"))
    assert {r["merged_rows"] for r in again.collect()} == {1} and values(again, S.NOTES) == values(out, S.NOTES)
    shuffled = dedup.survivors(df.repartition(3, S.NAME))
    assert values(shuffled, S.NOTES) == values(out, S.NOTES)
    assert dedup.survivors(df, match_empty_key=True).count() == 8


def test_merge_strategies_and_fold(spark):
    cases = [("append", "A", "B", "A; B"), ("append", "A; B", "B", "A; B"), ("keep_theirs", "A", "", "A"), ("keep_ours", "", "B", "B"), ("keep_theirs", "A", "B", "B"), ("skip", "A", "B", "A")]
    for s, a, b, want in cases:
        assert spark.range(1).select(merge.combined(F.lit(a), F.lit(b), s).alias("v")).first().v == want
    old = catalog(spark, [{"name": "Aa", "cat": "x"}, {"name": "aa", "cat": "y"}, {"name": "B"}])
    new = catalog(spark, [{"name": "AA", "cat": "p"}, {"name": "Aa", "cat": "q"}, {"name": "New", "url": "https://admin.thegrid.id/?rootId=r9"}])
    found = match.import_matches(new, old)
    out = merge.upsert(old, new, found, merge.RECOMMENDED)
    assert values(out, S.CATEGORY) == {0: "x", 1: "y; p; q", 2: "", 5: ""}
    assert values(out, S.ROOT)[5] == "r9" and values(out, S.NAME)[1] == "aa"
    assert tuple(merge.match_counts(found).first()) == (1, 2, 0)


def test_preview_is_what_the_commit_does(spark):
    old, new = catalog(spark, [{"name": "Aa", "cat": "x", "src": "s"}]), catalog(spark, [{"name": "Aa", "cat": "y", "src": "t"}])
    found = match.import_matches(new, old)
    own = lambda df, n: df.select("row_id", F.struct(*[F.col(f"`{c}`") for c in S.CATALOG]).alias(n))
    shown = merge.preview(own(old, "ours").join(own(new, "theirs"), "row_id"), S.CATALOG, {S.SOURCE: "keep_theirs"}).collect()
    done = merge.upsert(old, new, found, {S.SOURCE: "keep_theirs"}).first()
    assert {r.column: r.resolved for r in shown} == {S.CATEGORY: "x; y", S.SOURCE: "t"}
    assert all(done[r.column] == r.resolved for r in shown)


def test_columns_are_mapped_by_name():
    got = mapping.suggest(["project name", "Url", "Telegramm", "Twitter", "X Link", "zzz"])
    assert [(g["target"], g["type"]) for g in got.values()][:4] == [(S.NAME, "matched"), (S.WEBSITE, "matched"), ("Telegram", "suggested"), ("X Link", "matched")]
    assert got["Telegramm"]["confidence"] == "fuzzy (94%)" and got["zzz"]["type"] == "extra"
    assert len({g["target"] for g in got.values() if g["target"]}) == sum(g["target"] is not None for g in got.values())


def test_sheets_and_legacy_tables(spark):
    df = spark.createDataFrame([(1, " A ", "", "p2", "r2", "Added"), (2, "B", "r1", "p2", "r2", "")], "row_id long, Name string, `Root ID` string, `Profile Name 2` string, `Root ID 2` string, `Final Status` string")
    out = mapping.apply_mapping(df, {"Name": S.NAME, "Root ID": S.ROOT, "Final Status": mapping.SKIP})
    assert [(r[S.NAME], r[S.ROOT], r[S.PROFILE]) for r in out.orderBy("row_id").collect()] == [("A", "r2", "p2"), ("B", "r1", "")]
    assert mapping.computed_columns(df) == ["Final Status"]
    old = spark.createDataFrame([("N", "", "@h", "near")], "Name string, `Best URL` string, `Best social` string, Chain string")
    row = mapping.migrated(old).first()
    assert (row[S.NAME], row[S.X_LINK], row[S.CHAIN]) == ("N", "https://x.com/h", "near")


def snapshot(spark):
    f = lambda rows, schema: spark.createDataFrame(rows, schema)
    return {
        "reg_root": f([("r1", "ref_finance", "https://ref.finance"), ("r2", "flux", "https://flux.xyz"), ("r3", "spin", "https://spin.fi")], "root_id string, slug string, url_main string"),
        "reg_profile": f([("1", "r1", "Ref Finance", "Active"), ("2", "r2", "Flux Finance", "Active"), ("3", "r3", "Degen Spin", "Inactive")], "profile_id string, root_id string, name string, status string").withColumns({"description_short": F.lit(""), "type": F.lit(""), "sector": F.lit("")}),
        "reg_product": f([("9", "r1", "Ref", "dex", "Live")], "product_id string, root_id string, name string, type string, status string"),
        "reg_asset": f([("a", "r1", "Ref Token", "REF")], "asset_id string, root_id string, name string, ticker string"),
        "reg_entity": f([("e", "Ref Ltd", "", "X")], "entity_id string, name string, trade_name string, country string"),
        "reg_support": f([("9", "USDT", "Tether", "supported_by"), ("9", "SOL", "Solana", "issued_by")], "product_id string, asset_ticker string, asset_name string, support_slug string"),
        "reg_social": f([("r2", "Twitter / X", "fluxdefi", "")], "root_id string, social_type string, name string, url string"),
    }


def test_registry_cascade_and_gaps(spark):
    rows = catalog(spark, [{"name": "Ref Finance"}, {"name": "Flux Protocol", "site": "https://other.org"}, {"name": "Zed", "site": "https://www.spin.fi/app"}, {"name": "Who", "handle": "@fluxdefi"}, {"name": "None"}, {"name": "Ref Finance", "status": "✅ Active"}, {"name": "Degen SPIN!"}])
    out = enrich.expand_matches(rows, snapshot(spark))
    # a key of three characters is too short for a match by name
    assert values(out, S.VIA) == {0: "slug", 1: "", 2: "batch-url", 3: "twitter", 4: "", 5: "", 6: "batch-name"}
    assert values(out, S.EVIDENCE)[0] == "Grid: Ref Finance (profile) | expanded-grid"
    step = enrich.enrich_registry_support(out, snapshot(spark), ["USDT", "SOL"])
    assert values(step, S.NOTES)[0] == "Grid confirms: USDT" and values(step, S.USDT)[0] == "TRUE" and values(step, S.USDT)[2] == ""
    again = enrich.enrich_registry_support(step, snapshot(spark), ["USDT", "SOL"])
    assert values(again, S.NOTES) == values(step, S.NOTES) and values(again, S.EVIDENCE) == values(step, S.EVIDENCE)


def test_registry_searches(spark):
    score = lambda a, b: spark.range(1).select(registry.name_score(F.lit(a), F.lit(b)).alias("v")).first().v
    assert [score("Degen Spin", "Spin"), score("Spin", "Degen Spin"), score("Spinner", "Spin"), score("aspin", "Spin"), score("x", "y")] == [0.9, 0.85, 0.8, 0.6, 0.0]
    rows = catalog(spark, [{"name": "Spin Protocol"}, {"name": "zz", "site": "flux.xyz"}])
    got = {r.row_id: (r.entry_id, r.method) for r in registry.search_match(rows, snapshot(spark)).collect()}
    assert got == {1: ("2", "url")}  # "degen spin" and "spin protocol" score nothing against each other
    terms = spark.createDataFrame([("Ref Finance",), ("Ref",), ("nothing",)], "term string")
    multi = {r.term: r for r in registry.multi_match(terms, snapshot(spark)).withColumns(registry.match_views()).collect()}
    assert multi["Ref"].primary.name == "Ref" and multi["Ref"].primary.confidence == 1.6 and not multi["nothing"].matched
    assert {m.kind for m in multi["Ref"].matches} >= {"product", "profile"}


def test_best_entry_prefers_profiles(spark):
    c = spark.createDataFrame([(1, "Abc", "product", 1, "9", "Abc", "Active"), (1, "Abc", "profile", 0, "1", "Abc", "Inactive")], "row_id long, row_name string, kind string, kind_rank int, entry_id string, name string, status string")
    assert registry.best_entry(c).first().entry_id == "1"


def test_holdings(spark):
    series = lambda *maps: [{"date": i, "tokens": m} for i, m in enumerate(maps)]
    rows = [("a", ["Solana", "Near"], {"near": {"tokensInUsd": series({"USDT": 1.0}, {"USDT.e": 2.0, "USDT": 3.0, "weird": 9.0})}}, None), ("b", [], {}, series({"USDC": 5.0}))]
    h = "array<struct<date: bigint, tokens: map<string, double>>>"
    details = spark.createDataFrame(rows, f"slug string, chains array<string>, chainTvls map<string, struct<tokensInUsd: {h}>>, tokensInUsd {h}")
    got = {(r.slug, r.asset): r.usd for r in enrich.holdings(details, "near", ["USDT", "USDC", "SOL"]).collect()}
    assert got == {("a", "USDT"): 5.0, ("a", "SOL"): 0.01, ("b", "USDC"): 5.0}
    protocols = spark.createDataFrame([("Ref", "a", "", ["Near"], 0), ("B", "b", "", [], 1)], "name string, slug string, url string, chains array<string>, pos int")
    cat = catalog(spark, [{"name": "ref"}, {"name": "b", "notes": "x"}, {"name": "c"}])
    out = enrich.enrich_holdings(cat, protocols, details, "near", ["USDT", "USDC", "SOL"])
    assert values(out, S.EVIDENCE) == {0: "USDT: $5 | SOL: $0", 1: "USDC: $5", 2: ""}
    assert values(out, S.NOTES) == {0: "Supports USDT; Solana chain presence", 1: "x | USDC support found, no evidence of USDT support", 2: ""}
    assert values(out, S.USDT) == {0: "TRUE", 1: "", 2: ""} and values(out, S.STABLE)[1] == "TRUE"
    again = enrich.enrich_holdings(out, protocols, details, "near", ["USDT", "USDC", "SOL"])
    assert values(again, S.EVIDENCE) == values(out, S.EVIDENCE)


def test_deployments(spark):
    coins = spark.createDataFrame([(0, "near-coin", "Near Coin", "NRC", {"solana": "0x", "tron": "1"}), (1, "rainbow", "Rainbow Bridge", "RB", {"cardano": "c", "solana": ""})], "pos bigint, id string, name string, symbol string, platforms map<string, string>")
    cat = catalog(spark, [{"name": "Near-Coin Labs", "src": "x"}, {"name": "Rainbow Bridges"}, {"name": "nrc"}, {"name": "zz"}])
    out = enrich.enrich_deployments(cat, coins, ["SOL", "ADA"])
    assert values(out, S.EVIDENCE) == {0: "SOL: deployed on solana (CoinGecko)", 1: "", 2: "SOL: deployed on solana (CoinGecko)", 3: ""}
    assert values(out, S.NOTES)[1] == '[UNVERIFIED] CoinGecko fuzzy match: "Rainbow Bridge" (rainbow) — ADA deployment detected'
    assert values(out, S.SOURCE)[0] == "x; CoinGecko"


def test_scan_and_promotion(spark):
    texts = spark.createDataFrame([(0, "we hold usdt and tether with " + "word " * 20, 1), (1, "usdc stablecoin on solana " + "word " * 20, 3), (2, "swap and dex yields only " + "word " * 20, 1)], "row_id long, text string, pages_fetched long")
    cat = catalog(spark, [{"name": f"n{i}", "site": f"s{i}.com"} for i in range(4)])
    out = enrich.scan_websites(cat, texts, ["USDT", "USDC", "SOL"])
    assert values(out, S.NOTES) == {
        0: "[UNVERIFIED website-scan] USDT keywords (usdt; tether)",
        1: "[UNVERIFIED website-scan] USDC keywords (usdc) | SOL keywords (solana) | stablecoin mentions",
        2: "[UNVERIFIED website-scan] web3 signals (swap; dex; yield)",
        3: "",
    }
    assert values(out, S.EVIDENCE)[1] == "website-scan: crawled(3)" and values(out, S.EVIDENCE)[3] == "website-scan: scanned"
    done = enrich.promote_hints(out)
    assert values(done, S.USDT)[0] == "TRUE" and values(done, S.STABLE)[1] == "TRUE" and values(done, S.WEB3)[2] == "TRUE"
    assert values(done, S.NOTES)[1].endswith("| USDC support found, no evidence of USDT support") and "[PROMOTED from website-scan]" in values(done, S.NOTES)[0]
    for step in (enrich.promote_hints, lambda d: enrich.scan_websites(d, texts, ["USDT"])):
        assert values(step(done), S.NOTES) == values(done, S.NOTES) and values(step(done), S.EVIDENCE) == values(done, S.EVIDENCE)
    scan = spark.range(1).select(enrich.parsed_scan(F.lit("a | [UNVERIFIED website-scan] USDC keywords (x) | DAI keywords (dai) | other | USDT keywords (z)")).alias("s")).first().s
    assert scan.has_usdc and not scan.has_usdt and scan.others == ["DAI"] and scan.asset_count == 2


def test_keyword_catalog(spark):
    coins = spark.createDataFrame([("DAI", ["dai"]), ("TUSD", ["tusd", "trueusd"]), ("U", ["us dollar x"])], "symbol string, keywords array<string>")
    texts = spark.createDataFrame([(1, "pay with dai, trueusds and us dollar x"), (2, "daily éusdt"), (3, "tusd")], "row_id long, text string")
    got = {r.row_id: [(f.asset, f.words) for f in r.found] for r in enrich.catalog_keywords(texts, coins).collect()}
    assert got == {1: [("DAI", ["dai"]), ("TUSD", ["trueusd"]), ("U", ["us dollar x"])], 3: [("TUSD", ["tusd"])]}


def test_many_keywords_are_found_without_moving_texts(spark, monkeypatch):
    moved, containing = [], enrich.match.containing
    monkeypatch.setattr(enrich.match, "containing", lambda terms, texts, *how: moved.append(texts.columns) or containing(terms, texts, *how))
    n = enrich.LISTED_WORDS + 60  # more than are looked for one by one
    coins = spark.createDataFrame([(f"S{i:04d}", [f"s{i:04d}", f"kéyword{i:04d}"]) for i in range(n)], "symbol string, keywords array<string>")
    rows = [(i, f"unkéyword{i:04d}s kéyword{i:04d}, s{i:04d}x") for i in range(0, n, 7)]
    found = enrich.catalog_keywords(spark.createDataFrame(rows, "row_id long, text string"), coins)
    assert {r.row_id: [(f.asset, f.words) for f in r.found] for r in found.collect()} == {i: [(f"S{i:04d}", [f"kéyword{i:04d}"])] for i, _ in rows}
    assert moved == [["text"]]


def test_health_and_sources(spark):
    log = spark.sql("select 'a.com' url, 204 http_code, cast(null as string) error_type, '' detail, timestamp'2024-01-02' fetched_at union all select 'b.com', cast(null as int), 'dns', 'no host', timestamp'2024-01-02' union all select 'a.com', 404, null, '', timestamp'2024-01-01'")
    cat = catalog(spark, [{"site": "a.com", "notes": "[website-health] DEAD: old"}, {"site": "b.com", "notes": "n"}, {"site": "c.com"}])
    out = enrich.check_health(cat, log)
    assert values(out, S.EVIDENCE) == {0: "health-check: alive (204)", 1: "health-check: dns_fail (dns_fail)", 2: ""}
    assert values(out, S.NOTES) == {0: "", 1: "n | [website-health] DEAD: no host", 2: ""}
    codes = spark.createDataFrame([(204, None), (302, None), (404, None), (None, "timeout"), (None, "dns"), (None, "ssl")], "c int, e string")
    assert [r.o for r in codes.select(enrich.outcome(F.col("c"), F.col("e")).alias("o")).collect()] == ["alive", "alive", "dead", "timeout", "dns_fail", "error"]
    src = catalog(spark, [{"src": "Generic Scraper; A.com; a.com", "site": "https://a.com/x"}, {"src": "Generic Scraper"}, {"src": "X"}])
    assert values(enrich.repair_sources(src, "none"), S.SOURCE) == {0: "a.com", 1: "Generic Scraper", 2: "X"}
    assert values(enrich.repair_sources(src, "near"), S.SOURCE)[1] == "wallet.near.org"


def test_reports_of_nothing(spark):
    empty = catalog(spark, [])
    assert reports.kpis(empty).first().total == 0 and reports.kpis(empty).first().matched_pct == 0.0
    assert reports.health_rollup(empty).first().dead_pct == 0.0
    assert reports.source_breakdown(empty).count() == 0 and dedup.counters(empty).first().total_rows == 0


def test_filters(spark):
    cat = catalog(spark, [{"name": "Ab%c", "ev": "health-check: dead (404)"}, {"name": "abc"}])
    assert sorted(values(cat.where(filters.catalog_filter(name="B%")), S.NAME)) == [0]
    assert sorted(values(cat.where(filters.catalog_filter(health="unchecked")), S.NAME)) == [1]


def test_site_texts_cap_before_lookup(spark):
    home = '<a href="/p1">x</a><a href="p2?x=1">y</a><a href="https://other.org/z">z</a><a href="/i.png">i</a>' + "home text " * 10
    rows = [(1, "https://a.com", home), (2, "https://a.com/about", "about " * 20), (3, "https://a.com/p1", "first " * 20), (4, "https://a.com/p2", "second " * 20)]
    p = spark.createDataFrame(rows, "page_id long, url string, html string")
    cat = catalog(spark, [{"site": "a.com"}, {"site": "gone.com"}])
    both = pages.site_texts(cat, p).collect()
    assert len(both) == 1 and both[0].pages_fetched == 2 and "about" in both[0].text and "first" not in both[0].text
    links = pages.site_texts(cat, p, mode="links").first()
    assert links.pages_fetched == 3 and links.text.index("first") < links.text.index("second")
    assert [(r.place, r.link) for r in pages.same_domain_links(p.where("page_id = 1")).orderBy("place").collect()] == [(1, "https://a.com/p1"), (2, "https://a.com/p2")]


def test_records_from_pages(spark):
    items = ", ".join(f'{{"name": "Item {i}", "slug": "s{i}"}}' for i in range(6))
    data = f'<script id="__NEXT_DATA__" type="application/json">{{"props": {{"list": [{items}], "map": {{"k": {{"name": "M"}}}}}}}}</script>'
    table = "<table>" + "".join(f"<tr><td><b>T{i}</b></td><td>{i}</td></tr>" for i in range(5)) + "</table>"
    links = "".join(f'<a href="/app/x{i}">App {i}</a>' for i in range(5)) + '<a href="/blog/a">no</a>'
    stream = r'self.__next_f.push([1,"{\"a\": "])self.__next_f.push([1,"{\"b\": 2}}"])'
    p = spark.createDataFrame([(1, "https://a.com", data), (2, "https://a.com", table + links), (3, "https://a.com", stream)], "page_id long, url string, html string")
    got = sorted((r.page_id, r["name"]) for r in pages.page_records(p, ["$.props.list"]).collect())
    assert got == sorted([(1, f"Item {i}") for i in range(6)] + [(2, f"x{i}") for i in range(5)] + [(2, f"T{i}") for i in range(5)])
    assert [r._mapKey for r in pages.json_map_records(p, "$.props.map").collect()] == ["k"]
    assert p.where("page_id = 3").select(F.to_json(pages.stream_json("html")).alias("j")).first().j == '{"a":{"b":2}}'
    assert sorted(r["name"] for r in pages.link_list(p, r"^/app/(\w+)$", {"chain": "near"}).collect()) == [f"App {i}" for i in range(5)]


def test_csv_round_trip_and_columns(spark, tmp_path):
    df = catalog(spark, [{"name": 'Quo"te, here', "notes": "a\nb"}, {"name": "ünï", "ev": "x"}]).withColumn("Extra", F.lit("e"))
    store.write_csv(df, str(tmp_path / "c"))
    back = store.read_csv(spark, str(tmp_path / "c"))
    assert back.columns[:27] == S.CATALOG and sorted(r[S.NAME] for r in back.collect()) == ['Quo"te; here', "ünï"]
    assert {r[S.NOTES] or "" for r in back.collect()} == {"a b", ""}
    with pytest.raises(store.MissingColumns, match="Notes"):
        store.validated(df.drop(S.NOTES))
    (tmp_path / "t.tsv").write_bytes("a\tb\ncaf\xe9\t1\n".encode("latin-1"))
    sheet = store.read_sheet(spark, str(tmp_path / "t.tsv"))
    assert [(r.a, r.b) for r in sheet.collect()] == [("café", "1")]
    out = store.export([df, df.drop("Extra").withColumn("Z", F.lit(None).cast("string"))])
    assert out.columns[:27] == S.CATALOG and out.columns[-2:] == ["Extra", "Z"] and {r.Z for r in out.collect()} == {""}


def test_chain_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_table(catalog(spark, [{"name": "a", "eco": "x"}, {"name": "b", "eco": "y"}]), path)
    store.write_table(catalog(spark, [{"name": "c", "eco": "x"}]), path)
    assert [r[S.NAME] for r in store.read_chain(spark, path, "x").collect()] == ["c"]
    assert spark.read.parquet(path).count() == 2


def test_pipeline_rolls_a_failed_step_back(spark, tmp_path):
    def fails(df):
        raise RuntimeError("no")

    steps = [("clean", enrich.clean_notes), ("bad", fails), ("repair", lambda d: enrich.repair_sources(d, "near"))]
    cat = catalog(spark, [{"name": "a", "notes": "X from AwesomeNEAR", "src": "Generic Scraper"}])
    out = pipeline.run_steps(cat, steps, str(tmp_path), "r1")
    row = out.table.first()
    assert (row[S.NOTES], row[S.SOURCE], out.failed) == ("", "wallet.near.org", "bad")
    assert out.counts["clean"]["total"] == 1 and pipeline.run_steps(cat, steps, str(tmp_path), "r2", stop=True).table.first()[S.SOURCE] == "Generic Scraper"
    assert [n for n, _ in pipeline.selected(steps, skip=("bad",))] == ["clean", "repair"]
    with pytest.raises(ValueError):
        pipeline.selected(steps, only=("zzz",))


def test_arrivals_are_added_once(spark, tmp_path):
    from rosterforge.streaming import arrivals

    source, target = str(tmp_path / "in"), str(tmp_path / "cat")
    catalog(spark, [{"name": "A"}, {"name": "a"}, {"name": "B"}]).write.parquet(source)
    for _ in range(2):
        stream = arrivals.incoming(spark, source, ", ".join(f"`{c}` {t}" for c, t in catalog(spark, []).dtypes))
        arrivals.append_arrivals(stream, target, str(tmp_path / "cp")).awaitTermination()
        catalog(spark, [{"name": "C"}, {"name": "b"}]).write.mode("append").parquet(source)
    assert sorted(r[S.NAME] for r in spark.read.parquet(target).collect()) == ["A", "B", "C"]


def test_one_entity_of_a_third_of_the_rows(spark):
    rows = [{"name": f"Name {i}", "src": "S"} for i in range(400)]
    rows += [{"name": "Large" if i % 2 else "LARGE", "src": f"S{i % 3}", "ev": f"e{i % 5} | e{i % 7}", "notes": f"n{i % 2} | tail {i % 4}", "site": "", "usdt": "TRUE" if i == 150 else ""} for i in range(200)]
    out = {r[S.NAME]: r for r in dedup.survivors(catalog(spark, rows).repartition(6)).collect()}
    one = out["LARGE"]
    assert len(out) == 401 and one["merged_rows"] == 200 and one["row_id"] == 400 and one[S.USDT] == "TRUE"
    assert one[S.SOURCE] == "S0; S1; S2" and one[S.EVIDENCE] == " | ".join(dict.fromkeys(x for i in [150, *(j for j in range(200) if j != 150)] for x in (f"e{i % 5}", f"e{i % 7}")))
    assert one[S.NOTES].startswith("n0 | tail 2 | ") and one[S.NOTES].endswith("(fuzzy dedup: merged from LARGE; Large | sources: S0; S1; S2)")
    assert set(one[S.NOTES].split(" | ")[2:-2]) == {"tail 0", "tail 1", "tail 3"}


def test_many_incoming_rows_for_one_target(spark):
    old = catalog(spark, [{"name": "T", "notes": "a", "cat": "", "src": "old"}, {"name": "U", "notes": " u "}])
    new = catalog(spark, [{"id": i, "name": "T", "notes": f"n{i % 3}", "cat": "" if i < 5 else f"c{i}", "src": f"s{i}" if i % 2 == 0 else ""} for i in range(300)])
    found = new.select("row_id", F.lit(0).cast("long").alias("match_id"))
    t, u = merge.upsert(old, new.repartition(5), found, {S.CATEGORY: "keep_ours", S.SOURCE: "keep_theirs", S.WEBSITE: "skip"}).orderBy("row_id").collect()
    assert (t[S.NOTES], t[S.CATEGORY], t[S.SOURCE], t[S.NAME]) == ("a; n0; n1; n2", "c5", "s298", "T") and u[S.NOTES] == " u "
