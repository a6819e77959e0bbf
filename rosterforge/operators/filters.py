"""Predicates over catalog rows, and the split into rows to do and rows done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.functions import evidence, text, urls
from rosterforge.schema import CATEGORY, EVIDENCE, MATCHED_URL, NAME, NOTES, PROFILE, ROOT, SOURCE, STATUS, WEBSITE, cell, filled, is_true

#: Registry states that count as matched (fixed values).
MATCHED_STATES = ["Active", "Inactive", "Acquired", "Announced", "Live", "Found", "Closed", "Dormant", "Archived", "Pending"]
#: Hosts too common to identify an entity (fixed values).
COMMON_DOMAINS = [
    "x.com", "twitter.com", "t.me", "telegram.org", "discord.gg", "discord.com",
    "github.com", "youtube.com", "reddit.com", "medium.com", "mirror.xyz",
    "linkedin.com", "facebook.com", "instagram.com", "near.org", "aurora.dev", "google.com", "apple.com",
]
DEAD = ["dead", "timeout", "dns_fail", "error"]
SHORTEST = 4


def contains_ci(c: str, part: str) -> Column:
    return F.lower(cell(c)).contains(part.lower())


def catalog_filter(
    name: str = "", category: str = "", source: str = "", matched: bool | None = None, with_evidence: bool | None = None, health: str = ""
) -> Column:
    """All given conditions together; ``health`` is alive, dead or unchecked."""
    tests = [contains_ci(c, v) for c, v in ((NAME, name), (CATEGORY, category), (SOURCE, source)) if v]
    if matched is not None:
        tests.append((filled(PROFILE) | filled(MATCHED_URL)) == matched)
    if with_evidence is not None:
        tests.append(filled(EVIDENCE) == with_evidence)
    state = evidence.health_status(EVIDENCE)
    if health:
        tests.append({"alive": state == "alive", "dead": state.isin(DEAD), "unchecked": state == ""}[health])
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def name_search(term: str) -> Column:
    return contains_ci(NAME, term)


def scan_eligible(rescan: bool = False) -> Column:
    """Sites to scan for keywords: fetchable, not yet scanned (a rescan skips only
    crawled ones) and without stronger evidence."""
    done = cell(EVIDENCE).rlike(r"website-scan: crawled\(\d+\)") if rescan else cell(EVIDENCE).contains("website-scan")
    proven = cell(EVIDENCE).rlike(r"Grid confirms|\(supported_by\)|USDT: \$|USDC: \$")
    return urls.is_fetchable(WEBSITE) & ~done & ~proven


def health_eligible(recheck: bool = False) -> Column:
    state = evidence.health_status(EVIDENCE)
    return urls.is_fetchable(WEBSITE) & ((state == "") | (state.isin(DEAD) if recheck else F.lit(False)))


def unmatched() -> Column:
    """Rows that the registry expansion should try."""
    has = text.status_text(STATUS).isin(MATCHED_STATES) | cell(STATUS).contains("✅")
    cleared = F.lower(cell(NOTES)).contains("false positive") & F.lower(cell(NOTES)).contains("grid match cleared")
    return ~has & ~cell(EVIDENCE).contains(evidence.EXPANDED) & ~cleared


def registry_matched() -> Column:
    return (filled(MATCHED_URL) | filled(ROOT)) & ~F.lower(cell(NOTES)).contains("false positive")


def identifying_domain(domain: Column) -> Column:
    return ~domain.isin(COMMON_DOMAINS) & (F.length(domain) >= SHORTEST)


def validation_queue() -> Column:
    return is_true("Added") & is_true("Processed?")


#: Where each step finds that a row is done.
STEP_MARKS: dict[str, Column | Callable[[], Column]] = {
    "holdings": lambda: cell(EVIDENCE).rlike(r"(^|\| )[A-Z0-9]{2,10}: \$"),
    "deployments": lambda: cell(EVIDENCE).contains("(CoinGecko)"),
    "registry_support": lambda: cell(NOTES).contains("Grid confirms"),
    "website_scan": lambda: cell(EVIDENCE).contains("website-scan"),
    "promote": lambda: cell(EVIDENCE).contains(evidence.PROMOTE_MARK),
}


def incremental(df: DataFrame, done: Column, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Applies a step to the rows that do not carry its mark; the others pass unchanged."""
    done = F.coalesce(done, F.lit(False))
    return step(df.where(~done)).unionByName(df.where(done), allowMissingColumns=True)


def stablecoin_eligible(market_cap: float = 1_000_000, shortest: int = 3) -> Column:
    return ~F.upper("symbol").isin("USDT", "USDC") & (F.col("market_cap") >= market_cap) & (F.length(F.trim("symbol")) >= shortest)


def registry_search(columns: list[str], term: str, case_sensitive: bool = False) -> Column:
    """Any of the columns holds the term."""
    out = F.lit(False)
    for c in columns:
        out = out | (cell(c).contains(term) if case_sensitive else contains_ci(c, term))
    return out


def types_of(df: DataFrame, column: str = "type", limit: int = 200) -> DataFrame:
    return df.where(filled(column)).select(column).distinct().orderBy(column).limit(limit)
