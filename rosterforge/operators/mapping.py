"""From foreign columns and records to the catalog's schema."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.functions.text import sanitized, usd
from rosterforge.functions.urls import handle, profile_link
from rosterforge.schema import CATALOG, CATEGORY, CHAIN, EVIDENCE, NAME, NOTES, PROFILE, ROOT, SOURCE, STATUS, USDT, VIA, WEB3, WEBSITE, X_HANDLE, X_LINK, cell, either, filled, ordered, trim
from rosterforge.sources.catalog import with_current_names

#: Legacy columns under present names (fixed values); other legacy columns are dropped.
LEGACY = {"Name": NAME, "Best URL": WEBSITE, "Best social": X_HANDLE, "Telegram Channels": X_HANDLE, "Status": STATUS, "AI Evidence URLs": EVIDENCE}
#: Other names of canonical columns (fixed values).
ALIASES = {
    "tags/categories": "Category",
    "description": "Notes",
    "ecosystem": "Ecosystem/Chain",
    "chain": "Ecosystem/Chain",
    "status": "The Grid Status",
    "twitter handle": "X Handle",
    "twitter": "X Link",
    "twitter link": "X Link",
    "twitter url": "X Link",
    "x": "X Handle",
    "x link": "X Link",
    "tg": "Telegram",
    "telegram link": "Telegram",
    "categories": "Category",
    "tags": "Category",
    "project": "Project Name",
    "name": "Project Name",
    "url": "Website",
    "site": "Website",
    "homepage": "Website",
}
#: Columns that a sheet computes, by all their values (fixed values).
COMPUTED = {"Final Status": ["Skipped", "Added", "Added Not Validated", "Validated", "To be added - Tether", "To be added - General", "Not Processed", ""]}
#: A sheet's first and second set of registry columns (fixed values).
PRIMARY = [PROFILE, ROOT, "Matched URL", VIA]
SECONDARY = ["Profile Name 2", "Root ID 2", "Matched URL 2", "Matched via 2"]
#: Scraped categories that suggest stablecoin use (fixed values).
DEFI = ["CEX", "Dexes", "Lending", "Derivatives", "Bridge", "RWA", "DeFi", "Exchanges", "Yield", "Liquid Staking", "Payments", "Launchpad"]
#: Where a source shows an entity (fixed values).
SOURCE_PAGES = {"dappradar": "https://dappradar.com/dapp/", "defillama": "https://defillama.com/protocol/"}
SKIP = "__skip__"


def migrated(df: DataFrame) -> DataFrame:
    """A legacy table in the present schema: a present column wins, else the first filled
    legacy column; links are derived from handles."""
    df = with_current_names(df)
    out = {}
    for c in CATALOG:
        old = [o for o, new in LEGACY.items() if new == c and o in df.columns]
        out[c] = cell(c) if c in df.columns else either(*old) if old else F.lit("")
    link = F.when(filled(out[X_LINK]), out[X_LINK]).when(trim(out[X_HANDLE]).startswith("http"), trim(out[X_HANDLE])).otherwise(profile_link(out[X_HANDLE]))
    keep = [F.col(c) for c in df.columns if c in ("row_id", "chain_id")]
    return df.select(*keep, *[(link if c == X_LINK else v).alias(c) for c, v in out.items()])


def column_changes(df: DataFrame, columns: list[str] = CATALOG) -> tuple[list[str], list[str]]:
    """(missing canonical columns, columns beyond them)."""
    return [c for c in columns if c not in df.columns], [c for c in df.columns if c not in columns]


def suggest(headers: list[str], columns: list[str] = CATALOG) -> dict[str, dict]:
    """Header -> {target, type, confidence}: an equal name in any case, a known alias, else
    the most similar free column above 0.7.  Each target is used once, headers in
    order; others are extra.  This looks at names only, never at rows."""
    free, found = dict.fromkeys(columns), {}
    by_lower = {c.lower(): c for c in columns}
    for h in headers:
        low = h.strip().lower()
        exact = by_lower.get(low)
        alias = ALIASES.get(low)
        if exact in free:
            target, kind, sure = exact, "matched", "exact"
        elif alias in free:
            target, kind, sure = alias, "matched", "alias"
        else:
            scores = [(SequenceMatcher(None, low, c.lower()).ratio(), -i, c) for i, c in enumerate(free)]
            best = max(scores, default=(0.0, 0, None))
            if best[0] > 0.7:
                target, kind, sure = best[2], "suggested", f"fuzzy ({best[0]:.0%})"
            else:
                target, kind, sure = None, "extra", ""
        if target:
            del free[target]
        found[h] = {"target": target, "type": kind, "confidence": sure}
    return found


def resolved_registry(df: DataFrame) -> dict[str, Column]:
    """The registry columns: the second set only where the first has no root id and it has one."""
    second = ~filled(ROOT) & filled("Root ID 2") if "Root ID 2" in df.columns else F.lit(False)
    get = lambda c: trim(c) if c in df.columns else F.lit("")
    return {a: F.when(second, get(b)).otherwise(get(a)) for a, b in zip(PRIMARY, SECONDARY, strict=True)}


def apply_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Renames by header -> target (``__skip__`` drops; of several for one target the last
    counts), trims, and resolves a second set of registry columns."""
    out: dict[str, Column] = {}
    for header, target in mapping.items():
        if target and target != SKIP and header in df.columns:
            out[target] = trim(header)
    if any(c in df.columns for c in SECONDARY):
        out |= resolved_registry(df)
    keep = [F.col(c) for c in ("row_id",) if c in df.columns]
    return df.select(*keep, *[v.alias(k) for k, v in out.items()])


def computed_columns(df: DataFrame, patterns: dict[str, list[str]] = COMPUTED) -> list[str]:
    """Columns all of whose values are a computed column's; one pass for all."""
    known = [c for c in patterns if c in df.columns]
    if not known:
        return []
    row = df.agg(*[F.coalesce(F.bool_and(trim(c).isin(patterns[c])), F.lit(False)).alias(f"c{i}") for i, c in enumerate(known)]).first()
    return [c for i, c in enumerate(known) if row[f"c{i}"]]


def scraped_to_catalog(df: DataFrame, chain: str, source: str) -> DataFrame:
    """Scraped records (see ``snapshots.SCRAPED``) as catalog rows."""
    defi = F.coalesce(F.col("category").isin(DEFI), F.lit(False))
    page = SOURCE_PAGES.get(source.lower())
    fallback = F.when(filled("slug"), F.concat(F.lit(page), F.col("slug"))).otherwise("") if page else F.lit("")
    url = F.when(cell("url") != "", cell("url")).when(cell("website") != "", cell("website")).otherwise(fallback)
    tvl = F.when(F.col("tvl") > 0, F.concat(F.lit(" - TVL: "), usd(F.col("tvl")))).otherwise("")
    values = {
        NAME: sanitized("name"),
        USDT: F.when(defi, "TRUE").otherwise(""),
        WEB3: F.when(defi, "").otherwise("TRUE"),
        NOTES: sanitized(F.concat(cell("category"), F.lit(f" from {source}"), tvl)),
        SOURCE: F.lit(source),
        CATEGORY: sanitized("category"),
        WEBSITE: url,
        X_LINK: profile_link("twitter"),
        X_HANDLE: cell("twitter"),
        CHAIN: F.lit(chain),
    }
    keep = [F.col(c) for c in ("row_id",) if c in df.columns]
    return ordered(df.select(*keep, *[v.alias(k) for k, v in values.items()]))


def protocols_to_catalog(df: DataFrame, chain: str) -> DataFrame:
    """Protocols as catalog rows; blank names drop out."""
    tvl = F.when(F.col("tvl") > 0, F.concat(F.lit("TVL: "), usd(F.col("tvl")))).otherwise("")
    h = handle("twitter")
    values = {
        NAME: trim("name"),
        WEBSITE: trim("url"),
        X_HANDLE: h,
        X_LINK: profile_link(h),
        CATEGORY: trim("category"),
        NOTES: tvl,
        SOURCE: F.lit("DefiLlama"),
        EVIDENCE: F.when(filled("slug"), F.concat(F.lit("https://defillama.com/protocol/"), F.col("slug"))).otherwise(""),
        CHAIN: F.lit(chain.upper()),
    }
    keep = [F.col(c) for c in ("row_id",) if c in df.columns]
    return ordered(df.where(filled("name")).select(*keep, *[v.alias(k) for k, v in values.items()]))


def _first_word(c: Column) -> Column:
    return F.element_at(F.split(F.trim(c), r"\s+"), 1)


#: Transforms by the names that field maps use.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "prefixAt": lambda c: F.when((c == "") | c.startswith("@"), c).otherwise(F.concat(F.lit("@"), c)),
    "joinComma": lambda c: F.array_join(c, ", "),
    "trim": F.trim,
    "firstWord": _first_word,
    "stripTicker": lambda c: F.trim(F.regexp_replace(c, r"\s*\(?\$[A-Za-z0-9]+\)?\s*$", "")),
    "objectKeys": lambda c: F.array_join(F.map_values(c), ", "),
}


def field_map(df: DataFrame, fields: dict[str, str | dict], chain: str = "") -> DataFrame:
    """A declarative projection: target -> dot path, ``$chain``, or {field, transform, csvSafe}."""
    out = []
    for target, rule in fields.items():
        rule = {"field": rule} if isinstance(rule, str) else rule
        value = F.lit(chain) if rule["field"] == "$chain" else F.col(rule["field"])
        if name := rule.get("transform"):
            value = TRANSFORMS[name](value)
        value = F.coalesce(value.cast("string"), F.lit(""))
        out.append((sanitized(value) if rule.get("csvSafe") else value).alias(target))
    return df.select(*out)


def json_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Fields of JSON text by path (``$.a.b``); what is no JSON gives nulls."""
    v = F.try_parse_json(F.col(column))
    return df.withColumns({name: F.try_variant_get(v, path, "string") for name, path in fields.items()})


def map_rows(df: DataFrame, column: str) -> DataFrame:
    """A map of records as rows, the key in ``_mapKey``."""
    return df.select(F.explode(column).alias("_mapKey", "_v")).select("_mapKey", "_v.*")
