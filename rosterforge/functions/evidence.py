"""The segments of evidence and notes: written by one step, read by another.

A segment is text between `` | ``; its kind shows in how it begins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge.schema import appended, cell, filled, parts, trim

UNVERIFIED, PROMOTED = "[UNVERIFIED website-scan]", "[PROMOTED from website-scan]"
PROMOTE_MARK = "promoted: website-scan"
EXPANDED = "expanded-grid"
HEALTH = r"health-check:\s*(\S+)(?:\s*\((\S+)\))?"


def segments(c: str | Column) -> Column:
    return parts(c, " | ")


def rendered(items: Column) -> Column:
    return F.array_join(F.filter(items, lambda s: F.coalesce(s, F.lit("")) != ""), " | ")


def kind(segment: Column) -> Column:
    """grid, coingecko, defillama, website, health, promoted or other; the first that fits."""
    return (
        F.when(segment.startswith("Grid:") | (segment == EXPANDED), "grid")
        .when(segment.contains("(CoinGecko)"), "coingecko")
        .when(segment.startswith("website-scan"), "website")
        .when(segment.startswith("health-check:"), "health")
        .when(segment == PROMOTE_MARK, "promoted")
        .when(segment.startswith("USDT:") | segment.startswith("USDC:") | segment.contains("defillama.com"), "defillama")
        .otherwise("other")
    )


def parsed(c: str | Column) -> Column:
    """array<struct(kind, key, value, raw)> of a cell's segments."""
    return F.transform(
        segments(c),
        lambda s: F.struct(
            kind(s).alias("kind"),
            F.trim(F.when(s.contains(":"), F.substring_index(s, ":", 1)).otherwise("")).alias("key"),
            F.trim(F.when(s.contains(":"), F.substring(s, F.instr(s, ":") + 1, F.length(s))).otherwise(s)).alias("value"),
            s.alias("raw"),
        ),
    )


def union(cells: Column) -> Column:
    """The distinct segments of an array of cells, in first-seen order, as one cell."""
    return F.array_join(F.array_distinct(F.flatten(F.transform(cells, segments))), " | ")


def health_status(c: str | Column) -> Column:
    """alive, dead, timeout, dns_fail, error, or empty where never checked."""
    return F.regexp_extract(cell(c), HEALTH, 1)


def with_health(c: str | Column, status: Column, code: Column) -> Column:
    """The cell with its health marker replaced."""
    bare = trim(F.regexp_replace(cell(c), r"\s*\|?\s*health-check:\s*\S+(\s*\(\S+\))?", ""))
    bare = trim(F.regexp_replace(bare, r"^\|\s*", ""))
    return appended(bare, F.concat(F.lit("health-check: "), status, F.lit(" ("), F.coalesce(code.cast("string"), status), F.lit(")")))


def with_health_note(c: str | Column, dead: Column, detail: Column) -> Column:
    """Notes without an old health note, and with a new one where the site is dead."""
    bare = trim(F.regexp_replace(cell(c), r"\s*\[website-health\][^|]*", ""))
    bare = trim(F.regexp_replace(F.regexp_replace(bare, r"^\|\s*", ""), r"\s*\|$", ""))
    return appended(bare, F.when(dead, F.concat(F.lit("[website-health] DEAD: "), detail)).otherwise(""))


def marked(c: str | Column, marker: str) -> Column:
    return cell(c).contains(marker)


def add_marker(c: str | Column, marker: str) -> Column:
    return F.when(marked(c, marker), cell(c)).otherwise(appended(c, F.lit(marker)))


def has_evidence(c: str | Column) -> Column:
    return filled(c)
