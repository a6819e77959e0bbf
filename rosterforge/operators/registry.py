"""Matching catalog rows against the external registry's snapshot tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rosterforge.functions import evidence, kernels
from rosterforge.functions.text import alnum_key, name_key, search_term, slug_candidates
from rosterforge.functions.urls import handle, registry_domain, root_id, url_key
from rosterforge.operators.filters import SHORTEST, identifying_domain
from rosterforge.operators.match import containing
from rosterforge.schema import EVIDENCE, MATCHED_URL, NAME, PROFILE, ROOT, ROW_ID, STATUS, VIA, WEBSITE, X_HANDLE, appended, cell, filled, trim
from rosterforge.sources import gram_index

#: Names under which the registry knows a target asset (fixed values; others go by their own).
ASSET_ALIASES = {"SOL": ["SOL", "Solana"], "STRK": ["STRK", "Starknet"], "ADA": ["ADA", "Cardano"]}
#: Words without meaning in a name (fixed values).
NOISE_WORDS = ["the", "a", "an", "of", "and", "for", "on", "in", "by", "is"]
#: Endings that tell of another entity (fixed values).
NOISE_ENDINGS = [" s.l.", " ltd", " ltd.", " gmbh", " inc", " inc.", " corp", " corp.", " llc", " plc", " pte", " slugs", " gang", " punks", " apes", " club"]
#: Words that a longer name may have beside a search (fixed values).
SMALL_WORDS = ["the", "a", "an", "of", "and", "for"]
CONFIDENT = 0.85


def _quoted(c: Column) -> Column:
    return F.regexp_replace(c, r"([^\p{L}\p{N}\s])", r"\\$1")


def _whole_word(text: Column, word: Column) -> Column:
    return F.when(word == "", False).otherwise(F.regexp_like(text, F.concat(F.lit(r"(?U)\b"), _quoted(word), F.lit(r"\b"))))


def flat(registry: dict[str, DataFrame]) -> DataFrame:
    """Profiles and products as one table: ``kind, kind_rank, entry_id, name, type, status,
    root_id, slug, url``."""
    root = registry["reg_root"].select("root_id", "slug", F.col("url_main").alias("url"))
    one = lambda df, kind, rank, i: df.select(F.lit(kind).alias("kind"), F.lit(rank).alias("kind_rank"), F.col(i).alias("entry_id"), trim("name").alias("name"), "type", "status", "root_id")
    both = one(registry["reg_profile"], "profile", 0, "profile_id").unionByName(one(registry["reg_product"], "product", 1, "product_id"))
    return both.where(F.length("name") >= 2).join(root, "root_id", "left")


def best_entry(candidates: DataFrame) -> DataFrame:
    """Of each row's candidates (``row_id, row_name`` and the columns of ``flat``) the best:
    profiles before products, active before live before others, then the
    similarity of the raw names; ties to the registry's order.  A single
    candidate is not scored."""
    n = F.count("*").over(W.partitionBy(ROW_ID))
    c = candidates.withColumn("_n", n)
    alone, several = c.where("_n = 1").withColumn("_s", F.lit(0.0)), c.where("_n > 1")
    state = F.when(F.col("status") == "Active", 1.0).when(F.col("status") == "Live", 0.8).otherwise(0.0)
    likeness = kernels.ratio(alnum_key("name"), alnum_key("row_name"))
    several = several.withColumn("_s", F.when(F.col("kind") == "profile", 2.0).otherwise(0.0) + state + likeness)
    entry = F.struct(*[F.col(x) for x in candidates.columns if x != ROW_ID])
    best = alone.unionByName(several).groupBy(ROW_ID).agg(F.min_by(entry, F.struct(-F.col("_s"), F.col("kind_rank"), F.col("entry_id"))).alias("e"))
    return best.select(ROW_ID, "e.*")


def confidence(row_name: Column, entry_name: Column) -> Column:
    a, b = alnum_key(row_name), alnum_key(entry_name)
    return (
        F.when(name_key(row_name) == name_key(entry_name), 1.0)
        .when(a == b, 0.98)
        .when(a.contains(b) | b.contains(a), 0.9)
        .otherwise(kernels.ratio(name_key(row_name), name_key(entry_name)))
    )


def by_name(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Equal name keys, else equal raw keys; guarded against look-alikes: names must share
    a word, and where raw names differ, other domains need a ratio of 0.90 and
    dropped endings one of 0.85."""
    keys = F.array_distinct(F.array(name_key("name"), alnum_key("name")))
    index = entries.withColumn("k", F.explode(keys)).where("k <> ''")
    r = rows.select(ROW_ID, trim(NAME).alias("row_name"), trim(WEBSITE).alias("row_url"))
    r = r.withColumns({"nk": name_key("row_name"), "rk": alnum_key("row_name")}).where(F.length("nk") >= SHORTEST)
    first = r.withColumn("k", F.col("nk")).join(index, "k")
    second = r.join(first.select(ROW_ID).distinct(), ROW_ID, "left_anti").where(F.length("rk") >= SHORTEST).withColumn("k", F.col("rk")).join(index, "k")
    best = best_entry(first.unionByName(second).drop("k").dropDuplicates([ROW_ID, "kind", "entry_id"]))
    best = best.withColumn("confidence", confidence(F.col("row_name"), F.col("name"))).where(F.col("confidence") >= CONFIDENT)

    words = lambda c: F.array_except(F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", ""), " +"), lambda w: w != ""), F.array(*map(F.lit, NOISE_WORDS)))
    mine, theirs = words("row_name"), words("name")
    apart = (F.size(mine) > 0) & (F.size(theirs) > 0) & ~F.arrays_overlap(mine, theirs)
    raw = F.col("rk") != alnum_key("name")
    d1, d2 = registry_domain("row_url"), registry_domain("url")
    elsewhere = raw & (d1 != "") & (d2 != "") & (d1 != d2)
    likeness = F.when(raw & (elsewhere | (F.col("nk") != F.col("rk"))), kernels.ratio(F.col("rk"), alnum_key("name"))).otherwise(1.0)
    best = best.where(~apart).withColumn("_r", likeness)
    ok = ~(elsewhere & (F.col("_r") < 0.90)) & ~((F.col("nk") != F.col("rk")) & raw & (F.col("_r") < 0.85))
    return best.where(ok).drop("_r", "nk", "rk", "row_url").withColumn("method", F.lit("batch-name"))


def _first_of_root(entries: DataFrame, kinds: tuple[str, ...] = ("profile", "product")) -> DataFrame:
    """One entry per root: profiles first, then the registry's order."""
    e = F.struct(*[F.col(c) for c in entries.columns if c != "root_id"])
    picked = entries.where(F.col("kind").isin(*kinds)).groupBy("root_id").agg(F.min_by(e, F.struct("kind_rank", "entry_id")).alias("e"))
    return picked.select("root_id", "e.*")


def by_domain(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Equal domains that identify an entity; one entry per root."""
    roots = _first_of_root(entries).withColumn("d", registry_domain("url"))
    r = rows.select(ROW_ID, trim(NAME).alias("row_name"), registry_domain(trim(WEBSITE)).alias("d")).where(identifying_domain(F.col("d")))
    best = best_entry(r.join(roots, "d").drop("d"))
    return best.withColumns({"confidence": F.lit(0.95), "method": F.lit("batch-url")})


def by_slug(rows: DataFrame, entries: DataFrame, threshold: float = 0.80) -> DataFrame:
    """The first slug candidate that a root has and whose name is near enough."""
    roots = _first_of_root(entries)
    r = rows.where(filled(NAME)).select(ROW_ID, trim(NAME).alias("row_name"), F.posexplode(slug_candidates(trim(NAME), registry_domain(trim(WEBSITE)))).alias("p", "slug"))
    hits = r.join(roots, "slug").withColumn("confidence", confidence(F.col("row_name"), F.col("name"))).where(F.col("confidence") >= threshold)
    e = F.struct(*[F.col(c) for c in hits.columns if c not in (ROW_ID, "p")])
    return hits.groupBy(ROW_ID).agg(F.min_by(e, "p").alias("e")).select(ROW_ID, "e.*").withColumn("method", F.lit("slug"))


def by_handle(rows: DataFrame, entries: DataFrame, social: DataFrame) -> DataFrame:
    """The same handle on the registry's social network ``Twitter / X``; the root's first profile."""
    own = lambda c: F.lower(F.regexp_replace(handle(c), "^@", ""))
    s = social.where(F.col("social_type") == "Twitter / X").select(own(F.when(filled("url"), F.col("url")).otherwise(F.col("name"))).alias("h"), "root_id").where("h <> ''")
    s = s.groupBy("h").agg(F.min("root_id").alias("root_id"))
    profiles = _first_of_root(entries, ("profile",))
    r = rows.select(ROW_ID, trim(NAME).alias("row_name"), own(X_HANDLE).alias("h")).where("h <> ''")
    return r.join(s, "h").join(profiles, "root_id").drop("h").withColumns({"confidence": F.lit(0.92), "method": F.lit("twitter")})


def cascade(rows: DataFrame, strategies: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """One match per row, by the first strategy that finds one.

    Strategies are independent, so each runs on all rows and the first one's match
    is kept: one job, with no table passed from strategy to strategy."""
    found = None
    for i, find in enumerate(strategies):
        got = find(rows).withColumn("_rank", F.lit(i))
        found = got if found is None else found.unionByName(got, allowMissingColumns=True)
    m = F.struct(*[F.col(c) for c in found.columns if c not in (ROW_ID, "_rank")])
    return found.groupBy(ROW_ID).agg(F.min_by(m, "_rank").alias("m")).select(ROW_ID, "m.*")


def apply_match(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Catalog rows with their match written into status, profile, root, URL, method and evidence."""
    m = matches.select(ROW_ID, F.struct("name", "kind", "type", "status", "root_id", "url", "method").alias("_m"))
    r = rows.join(m, ROW_ID, "left")
    hit, e = F.col("_m").isNotNull(), F.col("_m")
    kind = F.when((e["kind"] == "product") & filled(e["type"]), F.concat(F.lit(" ["), e["type"], F.lit("]"))).otherwise("")
    told = F.concat(F.lit("Grid: "), cell(e["name"]), F.lit(" ("), cell(e["kind"]), F.lit(")"), kind, F.lit(f" | {evidence.EXPANDED}"))
    new = {
        STATUS: F.when(filled(e["status"]), e["status"]).otherwise("Found"),
        PROFILE: cell(e["name"]),
        ROOT: cell(e["root_id"]),
        MATCHED_URL: cell(e["url"]),
        VIA: cell(e["method"]),
        EVIDENCE: appended(EVIDENCE, told),
    }
    return r.withColumns({c: F.when(hit, v).otherwise(cell(c)) for c, v in new.items()}).drop("_m")


def name_score(entry: Column, wanted: Column) -> Column:
    """1.0 equal, 0.9 / 0.85 one a whole word of the other, 0.8 a prefix, 0.6 a part, 0 none."""
    g, s = F.lower(trim(entry)), F.lower(trim(wanted))
    return (
        F.when(g == s, 1.0)
        .when(_whole_word(g, s), 0.9)
        .when(_whole_word(s, g), 0.85)
        .when(g.startswith(s) | s.startswith(g), 0.8)
        .when(g.contains(s) | s.contains(g), 0.6)
        .otherwise(0.0)
    )


def search_match(rows: DataFrame, registry: dict[str, DataFrame], limit: int = 5, index: str | None = None) -> DataFrame:
    """Name search, then URL search: of the first ``limit`` profiles that hold the row's search
    term the best of score 0.8 or more, else the first root whose URL holds the
    row's and that has a profile.  Any case; registry order is by id.

    ``index`` is the folder of a stored index of the profiles' lower-case names by entry id
    (``sources.gram_index``): then their texts are not taken apart again."""
    entries = flat(registry).where("kind = 'profile'")
    r = rows.select(ROW_ID, trim(NAME).alias("row_name"), F.lower(search_term(NAME)).alias("term"), url_key(WEBSITE).alias("site"))
    if index:
        found = gram_index.search(r.select("term"), index, limit).select("term", F.col("text_id").alias("entry_id")).join(entries, "entry_id")
    else:
        found = containing(r.select("term"), entries.withColumn("text", F.lower("name")), 3).drop("text")
    hits = r.select(ROW_ID, "row_name", "term").join(found, "term").drop("term")
    first = hits.withColumn("p", F.row_number().over(W.partitionBy(ROW_ID).orderBy("entry_id"))).where(F.col("p") <= limit)
    scored = first.withColumn("confidence", name_score(F.col("name"), F.col("row_name"))).where(F.col("confidence") >= 0.8)
    pick = lambda df, order: df.groupBy(ROW_ID).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns if c not in (ROW_ID, "p")]), order).alias("e")).select(ROW_ID, "e.*")
    named = pick(scored, F.struct(-F.col("confidence"), F.col("p"))).withColumn("method", F.lit("name"))
    rest = r.join(named.select(ROW_ID), ROW_ID, "left_anti").where("site <> ''")
    roots = _first_of_root(entries).where(filled("url")).withColumn("text", F.lower("url"))
    sites = rest.select(ROW_ID, "row_name", F.col("site").alias("term")).join(containing(rest.select(F.col("site").alias("term")), roots), "term").drop("term", "text")
    linked = pick(sites, F.col("root_id")).withColumns({"confidence": F.lit(1.0), "method": F.lit("url")})
    return named.unionByName(linked)


def multi_score(entry: Column, wanted: Column) -> Column:
    """How well a registry name fits a search, 0 to 2: a ladder from equal to contained, a
    bonus for a whole word, a penalty for endings of other entities."""
    e, s = F.lower(trim(entry)), F.lower(trim(wanted))
    noise = F.lit(False)
    for ending in NOISE_ENDINGS:
        noise = noise | (e.contains(ending) & ~s.contains(ending))
    extra = F.array_except(F.array_except(F.split(e, r"\s+"), F.split(s, r"\s+")), F.array(*map(F.lit, SMALL_WORDS)))
    ladder = (
        F.when(e == s, 1.0)
        .when(e.startswith(F.concat(s, F.lit(" "))) | e.startswith(F.concat(s, F.lit("-"))), F.when(noise, 0.4).otherwise(0.75))
        .when(e.startswith(s), F.when(noise, 0.3).otherwise(0.7))
        .when(e.contains(s), F.when((F.size(extra) > 1) | noise, 0.3).otherwise(0.5))
        .when(s.contains(e), 0.5)
        .otherwise(0.0)
    )
    bonus = F.when(_whole_word(s, e), 0.6).when(s.contains(e), 0.3).otherwise(0.0)
    penalty = F.when(noise & (e != s), 0.3).otherwise(0.0)
    return F.when(e == "", 0.0).otherwise(F.least(F.greatest(ladder + bonus - penalty, F.lit(0.0)), F.lit(2.0)))


def multi_match(searches: DataFrame, registry: dict[str, DataFrame], least: float = 0.6) -> DataFrame:
    """``searches(term)`` -> ``term, matched, matches``: all registry subjects that fit, the best
    first; of one name (any case) the first in the order profile, product,
    asset, entity.  Matches are structs of kind, id, name, confidence, ticker,
    url and country."""
    none = F.lit(None).cast("string")
    f = flat(registry).select("kind", "kind_rank", "entry_id", "name", none.alias("ticker"), "url", none.alias("country"))
    assets = registry["reg_asset"].select(F.lit("asset").alias("kind"), F.lit(2).alias("kind_rank"), F.col("asset_id").alias("entry_id"), trim("name").alias("name"), "ticker", none.alias("url"), none.alias("country"))
    entities = registry["reg_entity"].select(F.lit("entity").alias("kind"), F.lit(3).alias("kind_rank"), F.col("entity_id").alias("entry_id"), trim(F.when(filled("name"), F.col("name")).otherwise(F.col("trade_name"))).alias("name"), none.alias("ticker"), none.alias("url"), "country")
    subjects = f.unionByName(assets).unionByName(entities).withColumn("text", F.lower("name"))
    s = searches.where(F.length("term") >= 2).distinct().withColumn("low", F.lower("term"))
    pairs = s.join(containing(s.select(F.col("low").alias("term")), subjects).withColumnRenamed("term", "low"), "low")
    scored = pairs.withColumn("confidence", multi_score(F.col("name"), F.col("term"))).where(F.col("confidence") >= least)
    e = F.struct(-F.round("confidence", 2), F.col("kind_rank"), F.col("entry_id"), F.col("kind"), F.col("name"), F.round("confidence", 2).alias("confidence"), F.col("ticker"), F.col("url"), F.col("country"))
    first = scored.groupBy("term", "text").agg(F.min_by(e, F.struct("kind_rank", "entry_id")).alias("e"))
    got = first.groupBy("term").agg(F.array_sort(F.collect_list("e")).alias("m"))
    shaped = F.transform("m", lambda x: F.struct(x["kind"].alias("kind"), x["entry_id"].alias("id"), x["name"].alias("name"), x["confidence"].alias("confidence"), x["ticker"].alias("ticker"), x["url"].alias("url"), x["country"].alias("country")))
    return searches.distinct().join(got.select("term", shaped.alias("matches")), "term", "left").withColumn("matched", F.coalesce(F.size("matches") > 0, F.lit(False)))


def match_views(matches: str = "matches") -> dict[str, Column]:
    """The primary match, the matches of each kind, their number and their names."""
    of = lambda kind: F.filter(matches, lambda m: m["kind"] == kind)
    return {
        "primary": F.try_element_at(matches, F.lit(1)),
        **{f"{kind}_matches": of(kind) for kind in ("profile", "product", "asset", "entity")},
        "match_count": F.coalesce(F.size(matches), F.lit(0)),
        "match_names": F.coalesce(F.array_join(F.transform(matches, lambda m: m["name"]), ", "), F.lit("")),
    }


def url_match(searches: DataFrame, registry: dict[str, DataFrame], limit: int = 5) -> DataFrame:
    """``searches(url)`` -> ``url`` and every profile and product of the first ``limit`` roots
    whose main URL holds it, with confidence 1."""
    s = searches.distinct().withColumn("term", url_key("url")).where("term <> ''")
    roots = registry["reg_root"].select("root_id", F.lower("url_main").alias("text"))
    hits = s.join(containing(s.select("term"), roots), "term").withColumn("p", F.row_number().over(W.partitionBy("url").orderBy("root_id"))).where(F.col("p") <= limit)
    return hits.select("url", "root_id").join(flat(registry).drop("url"), "root_id").withColumn("confidence", F.lit(1.0))


def lookup(keys: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """Point lookups as one join: each key with the first row that has it (by all columns)."""
    row = F.struct(*[F.col(c) for c in table.columns if c != on])
    first = table.groupBy(on).agg(F.min(row).alias("r")).select(on, "r.*")
    return keys.join(first, on, "left")


def supported_tickers(registry: dict[str, DataFrame]) -> DataFrame:
    """``root_id, supported``: distinct tickers and names of assets that a root's products support."""
    s = registry["reg_support"].where("support_slug = 'supported_by'").join(registry["reg_product"].select("product_id", "root_id"), "product_id")
    named = s.select("root_id", F.explode(F.array("asset_ticker", "asset_name")).alias("a")).where(filled("a")).distinct()
    return named.groupBy("root_id").agg(F.array_sort(F.collect_list("a")).alias("supported"))


def target_support(supported: Column, targets: list[str]) -> Column:
    """Those of ``targets`` that the registry supports under any of their names."""
    held = F.coalesce(supported, F.array().cast("array<string>"))
    return F.array_compact(F.array(*[F.when(F.arrays_overlap(held, F.array(*map(F.lit, ASSET_ALIASES.get(t, [t])))), F.lit(t)) for t in targets]))


def support_gaps(rows: DataFrame, supported: DataFrame, targets: list[str]) -> DataFrame:
    """Per catalog row what the registry supports and what evidence shows but it does not,
    with a status: NOT IN GRID, GAPS FOUND, NO TARGET SUPPORT or OK."""
    r = rows.withColumn("_root", root_id(ROOT, MATCHED_URL)).join(supported.withColumnRenamed("root_id", "_root"), "_root", "left")
    have = target_support(F.col("supported"), targets)
    shown = F.filter(F.array(*map(F.lit, targets)), lambda t: cell(EVIDENCE).contains(t))
    r = r.withColumns({"grid_supported": have, "gaps": F.array_except(shown, have)})
    state = (
        F.when(~filled(F.col("_root")) & ~filled(MATCHED_URL), "NOT IN GRID")
        .when(F.size("gaps") > 0, "GAPS FOUND")
        .when(F.size("grid_supported") == 0, "NO TARGET SUPPORT")
        .otherwise("OK")
    )
    return r.withColumn("gap_status", state).drop("_root", "supported")


def root_data(rows: DataFrame, registry: dict[str, DataFrame]) -> DataFrame:
    """Matched rows with ``found_root``: by root id, else by URL where it is no admin URL."""
    roots = registry["reg_root"].select("root_id", url_key("url_main").alias("_u"))
    by_id = roots.select(F.col("root_id").alias("_id")).distinct()
    by_url = roots.where("_u <> ''").groupBy("_u").agg(F.min("root_id").alias("_by_url"))
    r = rows.withColumns({"_want": root_id(ROOT, MATCHED_URL), "_u": F.when(cell(MATCHED_URL).contains("admin.thegrid.id"), "").otherwise(url_key(MATCHED_URL))})
    r = r.join(by_id, F.col("_want") == F.col("_id"), "left").join(by_url, "_u", "left")
    return r.withColumn("found_root", F.coalesce("_id", "_by_url")).drop("_want", "_u", "_id", "_by_url")
