"""Steps that write evidence, notes and flags into catalog rows.

Every step is DataFrame -> DataFrame, keeps the rows it does not treat, and
finds its own mark on rows that it has treated, so that a rerun changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.functions import evidence
from rosterforge.functions.text import clean_note, coin_keywords, distinct_ci, usd
from rosterforge.functions.urls import domain
from rosterforge.operators import filters, mapping, match, registry
from rosterforge.schema import EVIDENCE, MATCHED_URL, NAME, NOTES, ROOT, ROW_ID, SOURCE, STABLE, USDT, WEB3, WEBSITE, appended, cell, filled, is_true, parts, trim
from rosterforge.sources.snapshots import on_chain

#: Token symbols that stand for an asset, as they are written (fixed values).
TOKENS = {
    "USDT": ["USDT", "USDT.e", "USDt", "USDT.b", "BUSDT", "fUSDT", "ceUSDT", "axlUSDT", "multiUSDT", "whUSDT", "zUSDT", "madUSDT", "tUSDT"],
    "USDC": ["USDC", "USDC.e", "axlUSDC", "multiUSDC", "whUSDC", "ceUSDC", "madUSDC", "bridgedUSDC", "USDbC", "cUSDC", "fUSDC", "zUSDC"],
    "SOL": ["SOL", "WSOL", "mSOL", "stSOL", "jitoSOL", "bSOL"],
    "STRK": ["STRK"],
    "ADA": ["ADA", "WADA"],
    "APT": ["APT", "stAPT", "amAPT", "tAPT"],
    "ETH": ["ETH", "WETH", "WSTETH", "stETH", "rETH", "cbETH", "swETH", "weETH", "ezETH"],
    "BTC": ["BTC", "WBTC", "tBTC", "cbBTC", "sBTC"],
}
#: Chains whose presence stands for an asset (fixed values).
CHAIN_ASSETS = {"solana": "SOL", "starknet": "STRK", "cardano": "ADA"}
CHAIN_NAMES = {"SOL": "Solana", "STRK": "Starknet", "ADA": "Cardano"}
#: Platforms that stand for an asset (fixed values).
PLATFORMS = {"solana": "SOL", "starknet": "STRK", "starknet-alpha": "STRK", "cardano": "ADA"}
#: What marks a presence without a known amount (fixed value).
PRESENCE = 0.01
#: Keywords by asset and kind (fixed values).
STABLE_WORDS = {"USDT": ["usdt", "tether"], "USDC": ["usdc", "usd coin"]}
CHAIN_WORDS = {"SOL": ["solana"], "STRK": ["starknet"], "ADA": ["cardano"], "APT": ["aptos"], "ETH": ["ethereum"], "BTC": ["bitcoin"]}
GENERIC_WORDS = ["stablecoin", "stablecoins", "stable coin"]
WEB3_WORDS = ["swap", "bridge", "dex", "liquidity", "yield", "lending", "borrow", "staking", "farming", "amm", "defi", "decentralized exchange", "liquidity pool"]
#: Catalog keywords that are looked for one by one in a text.
LISTED_WORDS = 500
#: Sources of a generic import by chain (fixed value).
GENERIC_SOURCES = {"near": "wallet.near.org"}
GENERIC = "Generic Scraper"


def _set(df: DataFrame, when: Column, values: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: F.when(when, v).otherwise(cell(c)) for c, v in values.items()})


def _note_once(finding: Column, unless: str | None = None) -> Column:
    """Notes with a finding, unless they hold it (or another text) already."""
    there = cell(NOTES).contains(finding) if unless is None else cell(NOTES).contains(finding) | cell(NOTES).contains(unless)
    return F.when(filled(NOTES) & there, cell(NOTES)).otherwise(appended(NOTES, finding))


# -- token holdings ---------------------------------------------------------


def token_assets(spark, targets: list[str]) -> DataFrame:
    """``symbol, asset`` for the target assets, the first target that knows a symbol."""
    known: dict[str, str] = {}
    for t in targets:
        for symbol in TOKENS.get(t, [t]):
            known.setdefault(symbol, t)
    return spark.createDataFrame(list(known.items()), "symbol string, asset string")


def holdings(details: DataFrame, chain: str, targets: list[str]) -> DataFrame:
    """Protocol details -> ``slug, asset, usd``: the latest snapshot of the chain's series (of
    the whole where the chain has none), summed per target asset; presence on an
    asset's own chain counts as a token amount where nothing is held."""
    series = F.try_element_at(F.col("chainTvls"), F.lit(chain))["tokensInUsd"]
    series = F.when(F.coalesce(F.size(series), F.lit(0)) > 0, series).otherwise(F.col("tokensInUsd"))
    latest = F.try_element_at(series, F.lit(-1))["tokens"]
    tokens = details.select("slug", F.explode(latest).alias("symbol", "usd")).withColumn("symbol", F.trim("symbol"))
    held = tokens.join(F.broadcast(token_assets(details.sparkSession, targets)), "symbol").groupBy("slug", "asset").agg(F.sum("usd").alias("usd"))
    own = F.create_map(*[F.lit(x) for kv in CHAIN_ASSETS.items() for x in kv])
    there = details.select("slug", F.explode(F.transform("chains", F.lower)).alias("c")).select("slug", F.try_element_at(own, F.col("c")).alias("asset"))
    there = there.where(F.col("asset").isin(targets)).distinct().withColumn("_here", F.lit(True))
    both = held.join(there, ["slug", "asset"], "full")
    amount = F.when(F.coalesce("_here", F.lit(False)) & (F.coalesce("usd", F.lit(0.0)) == 0), F.lit(PRESENCE)).otherwise(F.coalesce("usd", F.lit(0.0)))
    return both.select("slug", "asset", amount.alias("usd"))


def stablecoin_flags(df: DataFrame, has_usdt: Column, has_usdc: Column, when: Column | None = None) -> DataFrame:
    """Both or USDT: suspect, general where both; USDC alone: general; none: web3 only
    unless already suspect."""
    on = F.lit(True) if when is None else when
    any_ = has_usdt | has_usdc
    return df.withColumns(
        {
            USDT: F.when(on & has_usdt, "TRUE").otherwise(cell(USDT)),
            STABLE: F.when(on & has_usdc, "TRUE").otherwise(cell(STABLE)),
            WEB3: F.when(on & any_, "").when(on & ~any_ & (cell(USDT) == ""), "TRUE").otherwise(cell(WEB3)),
        }
    )


def enrich_holdings(rows: DataFrame, protocols: DataFrame, details: DataFrame, chain: str, targets: list[str]) -> DataFrame:
    """Catalog rows with their protocol's holdings as evidence, notes and flags."""

    def step(todo: DataFrame) -> DataFrame:
        found = match.protocol_lookup(todo, on_chain(protocols, chain))
        sums = holdings(details, chain, targets).groupBy("slug").agg(F.map_from_entries(F.collect_list(F.struct("asset", "usd"))).alias("_h"))
        r = found.join(sums, "slug", "left")
        amount = lambda a: F.coalesce(F.try_element_at("_h", F.lit(a)), F.lit(0.0))
        hit = F.col("_h").isNotNull()
        has = {a: amount(a) > 0 for a in dict.fromkeys([*targets, "USDT", "USDC"])}
        told = evidence.rendered(F.array(*[F.when(has[a], F.concat(F.lit(f"{a}: "), usd(amount(a)))) for a in targets]))
        stable = F.when(has["USDT"] & has["USDC"], "Supports USDT + USDC").when(has["USDT"], "Supports USDT").when(has["USDC"], "USDC support found, no evidence of USDT support")
        chains = [F.when(has.get(a, F.lit(False)), F.when(amount(a) <= PRESENCE, f"{n} chain presence").otherwise(f"{n} token detected")) for a, n in CHAIN_NAMES.items()]
        finding = F.array_join(F.array_compact(F.array(stable, *chains)), "; ")
        finding = F.when((finding == "") & (told == ""), "No target asset support detected").otherwise(finding)
        r = stablecoin_flags(r, has["USDT"], has["USDC"], hit)
        r = _set(r, hit, {EVIDENCE: appended(EVIDENCE, told), NOTES: F.when(finding == "", cell(NOTES)).otherwise(_note_once(finding))})
        return r.drop("slug", "_h")

    return filters.incremental(rows, filters.STEP_MARKS["holdings"](), step)


# -- deployments ------------------------------------------------------------


def platform_assets(platforms: Column, targets: list[str]) -> Column:
    """array<struct(asset, platform)> in target order for platforms with a contract; of
    several platforms of an asset the last by name counts."""
    known = F.create_map(*[F.lit(x) for kv in PLATFORMS.items() for x in kv])
    used = F.filter(F.map_entries(platforms), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    found = F.transform(used, lambda e: F.struct(F.try_element_at(known, F.lower(e["key"])).alias("asset"), e["key"].alias("platform")))
    of = lambda t: F.array_max(F.filter(found, lambda f: f["asset"] == t))
    return F.array_compact(F.array(*[of(t) for t in targets]))


def enrich_deployments(rows: DataFrame, coins: DataFrame, targets: list[str]) -> DataFrame:
    """Catalog rows with the platforms of their coin.  An exact match writes evidence, notes
    and source; a fuzzy one only an unverified note."""

    def step(todo: DataFrame) -> DataFrame:
        named = todo.withColumn("_name", cell(NAME))
        m = match.coins_of_names(named.select(F.col("_name").alias("name")).distinct(), coins).withColumnRenamed("name", "_name")
        m = m.join(coins.select(F.col("id").alias("coin_id"), F.col("name").alias("_coin"), "platforms"), "coin_id")
        m = m.select("_name", "coin_id", "method", "_coin", platform_assets(F.col("platforms"), targets).alias("_p"))
        r = named.join(m, "_name", "left").drop("_name")
        hit = F.coalesce(F.size("_p") > 0, F.lit(False))
        exact, fuzzy = hit & (F.col("method") == "exact"), hit & (F.col("method") == "fuzzy")
        told = F.array_join(F.transform("_p", lambda x: F.concat(x["asset"], F.lit(": deployed on "), x["platform"], F.lit(" (CoinGecko)"))), " | ")
        names = F.create_map(*[F.lit(x) for kv in CHAIN_NAMES.items() for x in kv])
        finding = F.array_join(F.transform("_p", lambda x: F.concat(F.try_element_at(names, x["asset"]), F.lit(" deployment (CoinGecko)"))), "; ")
        listed = F.array_join(F.array_sort(F.transform("_p", lambda x: x["asset"])), ", ")
        hint = F.concat(F.lit('[UNVERIFIED] CoinGecko fuzzy match: "'), F.col("_coin"), F.lit('" ('), F.col("coin_id"), F.lit(") — "), listed, F.lit(" deployment detected"))
        values = {
            EVIDENCE: F.when(exact & ~cell(EVIDENCE).contains("CoinGecko"), appended(EVIDENCE, told)).otherwise(cell(EVIDENCE)),
            NOTES: F.when(exact, _note_once(finding, "CoinGecko")).when(fuzzy, _note_once(hint, "CoinGecko fuzzy")).otherwise(cell(NOTES)),
            SOURCE: F.when(exact & ~cell(SOURCE).contains("CoinGecko"), appended(SOURCE, F.lit("CoinGecko"), "; ")).otherwise(cell(SOURCE)),
        }
        return r.withColumns(values).drop("coin_id", "method", "_coin", "_p")

    return filters.incremental(rows, filters.STEP_MARKS["deployments"](), step)


# -- registry ---------------------------------------------------------------


def enrich_registry_support(rows: DataFrame, snapshot: dict[str, DataFrame], targets: list[str]) -> DataFrame:
    """Matched rows with the target assets that the registry supports."""

    def step(todo: DataFrame) -> DataFrame:
        eligible = todo.where(filters.registry_matched())
        r = registry.root_data(eligible, snapshot)
        s = registry.supported_tickers(snapshot).withColumnRenamed("root_id", "found_root")
        have = registry.target_support(F.col("supported"), targets)
        r = r.join(s, "found_root", "left").withColumn("_have", have)
        hit = F.size("_have") > 0
        usdt, usdc = F.array_contains("_have", "USDT"), F.array_contains("_have", "USDC")
        told = F.concat(F.lit("Grid: "), F.array_join(F.transform("_have", lambda a: F.concat(a, F.lit(" (supported_by)"))), "; "))
        noted = F.concat(F.lit("Grid confirms: "), F.array_join("_have", "; "))
        values = {
            USDT: F.when(usdt | usdc, "TRUE").otherwise(cell(USDT)),
            WEB3: F.when(usdt | usdc, "").otherwise(cell(WEB3)),
            STABLE: F.when(usdt & usdc, "TRUE").otherwise(cell(STABLE)),
            EVIDENCE: F.when(cell(EVIDENCE).contains("Grid:"), cell(EVIDENCE)).otherwise(appended(EVIDENCE, told)),
            NOTES: _note_once(noted, "Grid confirms"),
        }
        done = _set(r, hit, values).drop("found_root", "supported", "_have")
        return done.unionByName(todo.where(~filters.registry_matched()))

    return filters.incremental(rows, filters.STEP_MARKS["registry_support"](), step)


def match_and_gaps(rows: DataFrame, snapshot: dict[str, DataFrame], targets: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with registry matches written in, gap report) from one match table."""
    found = registry.search_match(rows, snapshot)
    matched = registry.apply_match(rows, found)
    gaps = registry.support_gaps(matched, registry.supported_tickers(snapshot), targets)
    note = F.concat(F.lit("Grid missing: "), F.array_join("gaps", "; "))
    enriched = _set(gaps, F.size("gaps") > 0, {NOTES: _note_once(note)}).select(*matched.columns)
    report = gaps.select(
        cell(NAME).alias("Project Name"),
        cell(WEBSITE).alias("Website"),
        cell("Profile Name").alias("Profile Name"),
        cell(ROOT).alias("Root ID"),
        cell(MATCHED_URL).alias("Matched URL"),
        cell("Matched via").alias("Matched via"),
        F.array_join("grid_supported", "; ").alias("Supported"),
        F.array_join("gaps", "; ").alias("Gaps"),
        F.col("gap_status").alias("Status"),
    )
    return enriched, report


def expand_matches(rows: DataFrame, snapshot: dict[str, DataFrame]) -> DataFrame:
    """Tries names, domains, slugs and handles for rows without a match."""
    entries = registry.flat(snapshot)
    todo = rows.where(filters.unmatched())
    found = registry.cascade(
        todo,
        [
            lambda r: registry.by_name(r, entries),
            lambda r: registry.by_domain(r, entries),
            lambda r: registry.by_slug(r, entries),
            lambda r: registry.by_handle(r, entries, snapshot["reg_social"]),
        ],
    )
    return registry.apply_match(rows, found)


# -- keywords ---------------------------------------------------------------


def _holds(text: Column, word: str, whole_up_to: int) -> Column:
    return text.rlike(rf"(?U)\b{word}\b") if len(word) <= whole_up_to else text.contains(word)


def _hits(text: Column, words: list[str], whole_up_to: int) -> Column:
    return F.array_compact(F.array(*[F.when(_holds(text, w, whole_up_to), F.lit(w)) for w in words]))


def keyword_scan(text: Column, targets: list[str]) -> Column:
    """struct of assets (array of asset and its keywords, in dictionary order), generic
    (a stablecoin is mentioned) and web3 (keywords found) in lower-case text."""
    found = [F.struct(F.lit(a).alias("asset"), _hits(text, w, 5).alias("words")) for a, w in STABLE_WORDS.items() if a in targets]
    found += [F.struct(F.lit(a).alias("asset"), _hits(text, w, 4).alias("words")) for a, w in CHAIN_WORDS.items() if a in targets]
    empty = F.array().cast("array<struct<asset:string,words:array<string>>>")
    generic = reduce(lambda a, b: a | b, [text.contains(w) for w in GENERIC_WORDS])
    return F.struct(
        F.filter(F.array(*found) if found else empty, lambda x: F.size(x["words"]) > 0).alias("assets"),
        generic.alias("generic"),
        _hits(text, WEB3_WORDS, 4).alias("web3"),
    )


def catalog_keywords(texts: DataFrame, coins: DataFrame, key: str = ROW_ID, text: str = "text") -> DataFrame:
    """``key, found``: coins of a keyword catalog (``symbol, keywords``) named in each text.

    Words of up to 5 characters must be whole, longer ones may be anywhere.  Words of
    word characters alone lie within one word of a text: whole ones meet the texts'
    distinct words in an equi-join, longer ones are looked for in the distinct words
    of all texts first, so no text is moved.  The others are looked for in each text
    while they are at most ``LISTED_WORDS``; more are joined by their rarest trigram."""
    words = coins.select("symbol", F.posexplode("keywords").alias("p", "word")).where("word <> ''")
    plain, short = F.col("word").rlike(r"(?U)^\w+$"), F.length("word") <= 5
    single, inner, other = words.where(plain & short), words.where(plain & ~short), words.where(~plain)
    tokens = texts.select(key, F.explode(F.array_distinct(F.split(F.col(text), r"(?U)\W+"))).alias("word"))
    hits = tokens.join(single, "word").select(key, "symbol", "p", "word")
    known = tokens.where(~short).select(F.col("word").alias("text")).distinct()
    inside = match.containing(inner.select(F.col("word").alias("term")).distinct(), known, 6)
    within = tokens.join(inside.withColumnRenamed("text", "word"), "word").select(key, F.col("term").alias("word")).distinct()
    hits = hits.unionByName(within.join(inner, "word").select(key, "symbol", "p", "word"))
    distinct = other.select("word").distinct()
    listed = [r["word"] for r in distinct.limit(LISTED_WORDS + 1).collect()]
    if len(listed) <= LISTED_WORDS:
        there = F.filter(F.array(*map(F.lit, listed)).cast("array<string>"), lambda w: F.col("text").contains(w))
        held = texts.select(F.col(key), F.col(text).alias("text")).select(key, "text", F.explode(there).alias("word"))
    else:
        held = match.containing(distinct.select(F.col("word").alias("term")), texts.select(F.col(key), F.col(text).alias("text"))).withColumnRenamed("term", "word")
    bounded = (F.length("word") > 5) | F.regexp_like(F.col("text"), F.concat(F.lit(r"(?U)\b\Q"), F.col("word"), F.lit(r"\E\b")))
    hits = hits.unionByName(held.where(bounded).join(other, "word").select(key, "symbol", "p", "word"))
    per = hits.groupBy(key, "symbol").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "word"))), lambda x: x["word"]).alias("words"))
    return per.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("symbol").alias("asset"), "words"))).alias("found"))


def scan_note(scan: Column, more: Column | None = None) -> Column:
    """The unverified note of a scan, empty without findings; web3 words (five at most) only
    where no asset was found."""
    told = lambda arr: F.transform(arr, lambda x: F.concat(x["asset"], F.lit(" keywords ("), F.array_join(x["words"], "; "), F.lit(")")))
    empty = F.array().cast("array<string>")
    extra = empty if more is None else F.coalesce(told(more), empty)
    web3 = F.when((F.size(scan["assets"]) == 0) & (F.size(scan["web3"]) > 0), F.concat(F.lit("web3 signals ("), F.array_join(F.slice(scan["web3"], 1, 5), "; "), F.lit(")")))
    items = F.concat(told(scan["assets"]), extra, F.array_compact(F.array(F.when(scan["generic"], F.lit("stablecoin mentions")), web3)))
    return F.when(F.size(items) > 0, F.concat(F.lit(f"{evidence.UNVERIFIED} "), F.array_join(items, " | "))).otherwise("")


def scan_websites(rows: DataFrame, site_texts: DataFrame, targets: list[str], coins: DataFrame | None = None, rescan: bool = False) -> DataFrame:
    """Keyword notes from ``site_texts(row_id, text, pages_fetched)``; every eligible row is
    marked as scanned, whether or not its pages were there."""
    todo = rows.where(filters.scan_eligible(rescan))
    r = todo.join(site_texts.withColumnRenamed("text", "_text"), ROW_ID, "left")
    text = F.when(F.length("_text") >= 50, F.col("_text")).otherwise("")
    if coins is None:
        r = r.withColumn("_more", F.array().cast("array<struct<asset:string,words:array<string>>>"))
    else:
        r = r.join(catalog_keywords(site_texts, coins).withColumnRenamed("found", "_more"), ROW_ID, "left")
    note = F.when(text == "", "").otherwise(scan_note(keyword_scan(text, targets), F.col("_more")))
    old = F.filter(evidence.segments(NOTES), lambda s: ~s.contains(evidence.UNVERIFIED))
    kept = F.when(cell(NOTES).contains(evidence.UNVERIFIED) & (note != ""), F.array_join(old, " | ")).otherwise(cell(NOTES))
    n = F.coalesce("pages_fetched", F.lit(0))
    mark = F.when(n > 1, F.concat(F.lit("website-scan: crawled("), n.cast("string"), F.lit(")"))).otherwise("website-scan: scanned")
    bare = F.array_join(F.filter(evidence.segments(EVIDENCE), lambda s: ~s.startswith("website-scan")), " | ")
    done = r.withColumns({NOTES: F.when((note == "") | kept.contains(note), kept).otherwise(appended(kept, note)), EVIDENCE: appended(bare, mark)})
    return done.drop("_text", "_more", "pages_fetched").unionByName(rows.where(~filters.scan_eligible(rescan)))


def parsed_scan(notes: Column) -> Column:
    """What a scan note says: struct of has_scan, has_usdt, has_usdc, others (symbols),
    stablecoin, web3 and asset_count.  Only the segments from the tag on that
    belong to the scan count."""
    segs = F.split(notes, r" \| ")
    start = F.array_position(F.transform(segs, lambda s: s.contains(evidence.UNVERIFIED)), True)
    tail = F.slice(segs, F.greatest(start, F.lit(1)).cast("int"), F.size(segs))
    own = r"[A-Z0-9]{2,10}\s+keywords|stablecoin mentions|web3 ?(signals )?\("
    run = F.aggregate(
        tail,
        F.struct(F.array().cast("array<string>").alias("s"), F.lit(True).alias("on")),
        lambda acc, x: F.when(
            acc["on"] & ((F.size(acc["s"]) == 0) | x.rlike(own)), F.struct(F.array_append(acc["s"], F.trim(x)).alias("s"), F.lit(True).alias("on"))
        ).otherwise(F.struct(acc["s"].alias("s"), F.lit(False).alias("on"))),
    )["s"]
    text = F.array_join(run, " | ")
    symbols = F.regexp_extract_all(text, F.lit(r"([A-Z0-9]{2,10})\s+keywords"), F.lit(1))
    others = F.filter(symbols, lambda s: ~s.isin(*CHAIN_WORDS, "USDT", "USDC"))
    on = notes.contains(evidence.UNVERIFIED)
    return F.struct(
        on.alias("has_scan"),
        (on & F.array_contains(symbols, "USDT")).alias("has_usdt"),
        (on & F.array_contains(symbols, "USDC")).alias("has_usdc"),
        F.when(on, others).otherwise(F.array().cast("array<string>")).alias("others"),
        (on & text.contains("stablecoin mentions")).alias("stablecoin"),
        (on & F.lower(text).rlike(r"web3 ?(signals )?\(")).alias("web3"),
        F.when(on, F.size(F.array_distinct(symbols))).otherwise(0).alias("asset_count"),
    )


def promotion_rule(scan: Column) -> Column:
    """usdt, stablecoin, web3 or null: the first rule that fires on a row's scan and flags."""
    suspect, general, web3 = is_true(USDT), is_true(STABLE), is_true(WEB3)
    stable = scan["has_usdc"] | scan["stablecoin"] | (F.size(scan["others"]) > 0)
    return (
        F.when(scan["has_usdt"] & ~suspect, "usdt")
        .when(~scan["has_usdt"] & stable & ~suspect & ~general, "stablecoin")
        .when(~scan["has_usdt"] & ~stable & scan["web3"] & ~web3 & ~suspect, "web3")
    )


def promote_hints(rows: DataFrame) -> DataFrame:
    """Scan findings become flags by the first rule that fires; the note's tag is rewritten
    and the row marked, also where no rule fires."""

    def step(todo: DataFrame) -> DataFrame:
        r = todo.withColumn("_scan", parsed_scan(cell(NOTES)))
        r = r.withColumns({"_on": F.col("_scan.has_scan"), "_rule": F.when(F.col("_scan.has_scan"), promotion_rule(F.col("_scan")))})
        rule = F.coalesce("_rule", F.lit(""))
        coins = F.concat(F.when(F.col("_scan.has_usdc"), F.array(F.lit("USDC"))).otherwise(F.array().cast("array<string>")), F.col("_scan.others"))
        told = F.concat(F.array_join(coins, ", "), F.lit(" support found, no evidence of USDT support"))
        notes = F.replace(cell(NOTES), F.lit(evidence.UNVERIFIED), F.lit(evidence.PROMOTED))
        notes = F.when((rule == "stablecoin") & (F.size(coins) > 0) & ~notes.contains(told), appended(notes, told)).otherwise(notes)
        r = r.withColumns(
            {
                "_usdt": F.when(rule == "usdt", "TRUE").otherwise(cell(USDT)),
                "_stable": F.when((rule == "stablecoin") | ((rule == "usdt") & F.col("_scan.has_usdc")), "TRUE").otherwise(cell(STABLE)),
                "_web3": F.when(rule == "web3", "TRUE").when(rule != "", "").otherwise(cell(WEB3)),
                "_notes": notes,
                "_evidence": evidence.add_marker(EVIDENCE, evidence.PROMOTE_MARK),
            }
        )
        r = _set(r, F.col("_on"), {USDT: F.col("_usdt"), STABLE: F.col("_stable"), WEB3: F.col("_web3"), NOTES: F.col("_notes"), EVIDENCE: F.col("_evidence")})
        return r.drop("_scan", "_on", "_rule", "_usdt", "_stable", "_web3", "_notes", "_evidence")

    return filters.incremental(rows, filters.STEP_MARKS["promote"](), step)


# -- health, notes, sources -------------------------------------------------


def outcome(code: Column, error: Column) -> Column:
    """alive (200 to 399), dead (another code), timeout, dns_fail or error."""
    return (
        F.when(code.between(200, 399), "alive").when(code.isNotNull(), "dead").when(error == "timeout", "timeout").when(error.isin("dns", "dns_fail"), "dns_fail").otherwise("error")
    )


def check_health(rows: DataFrame, fetch_log: DataFrame, recheck: bool = False) -> DataFrame:
    """Eligible rows with the latest outcome of their site in evidence; dead sites are noted,
    notes of recovered ones removed.  Rows without a log entry are left."""
    latest = fetch_log.groupBy(F.col("url").alias("_u")).agg(F.max_by(F.struct("http_code", "error_type", "detail"), "fetched_at").alias("_l"))
    on = filters.health_eligible(recheck)
    r = rows.withColumn("_u", F.when(on, trim(WEBSITE))).join(latest, "_u", "left")
    hit = F.col("_l").isNotNull()
    status = outcome(F.col("_l.http_code"), F.col("_l.error_type"))
    detail = F.coalesce(F.col("_l.detail"), status)
    r = _set(r, hit, {EVIDENCE: evidence.with_health(EVIDENCE, status, F.col("_l.http_code")), NOTES: evidence.with_health_note(NOTES, status.isin(filters.DEAD), detail)})
    return r.drop("_u", "_l")


def clean_notes(rows: DataFrame) -> DataFrame:
    return rows.withColumn(NOTES, clean_note(NOTES))


def repaired_source(chain: str) -> Column:
    """The source with the generic importer's name replaced by the chain's page, else the
    website's host, and then without repeats; unchanged where neither is known."""
    host = F.lit(GENERIC_SOURCES[chain]) if chain in GENERIC_SOURCES else domain(WEBSITE)
    new = F.array_join(distinct_ci(parts(F.replace(trim(SOURCE), F.lit(GENERIC), host), ";")), "; ")
    return F.when(cell(SOURCE).contains(GENERIC) & (host != ""), new).otherwise(cell(SOURCE))


def repair_sources(rows: DataFrame, chain: str) -> DataFrame:
    return rows.withColumn(SOURCE, repaired_source(chain))


# -- discovery and catalogs -------------------------------------------------


def discover(existing: DataFrame, protocols: DataFrame, chain: str) -> DataFrame:
    """The protocols of a chain that the catalog lacks, as catalog rows."""
    return match.discovery_merge(mapping.protocols_to_catalog(on_chain(protocols, chain, lenient=False), chain), existing)


def stablecoin_catalog(coins: DataFrame) -> DataFrame:
    """Stablecoins to look for, with their keywords and the time of the build."""
    kept = coins.where(filters.stablecoin_eligible())
    return kept.withColumns({"keywords": coin_keywords(F.col("symbol"), F.col("name")), "fetched_at": F.current_timestamp()})


def top_coins(catalog: DataFrame, k: int = 20) -> DataFrame:
    return catalog.orderBy(F.desc("market_cap"), "symbol").limit(k)


def by_source_priority(rows: DataFrame, fields: list[str], priority: list[str], key: str = "key", source: str = "source") -> DataFrame:
    """One row per key: each field from the source of the highest priority that fills it."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, priority)), F.col(source)), F.lit(0))
    ranked = rows.withColumn("_p", F.when(rank == 0, len(priority) + 1).otherwise(rank))
    first = {f: F.coalesce(F.min_by(F.when(filled(f), cell(f)), F.when(filled(f), F.struct("_p", f))), F.lit("")) for f in fields}
    return ranked.groupBy(key).agg(*[v.alias(f) for f, v in first.items()])
