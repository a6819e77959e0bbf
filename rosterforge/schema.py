"""The catalog's schema and the expressions for its cells.

Cells are strings; missing is the empty string at the edges and may be null
inside, which all expressions here treat alike.  ``ROW_ID`` orders rows: it is
assigned at ingest and settles every tie.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_ID = "row_id"
CHAIN_ID = "chain_id"

#: Canonical columns in order (fixed values).
CATALOG = [
    "Project Name",
    "Suspect USDT support?",
    "Skip",
    "Added",
    "Web3 but no stablecoin",
    "General Stablecoin Adoption",
    "To be Added",
    "Processed?",
    "In Admin",
    "TG/TON appstore (no main URL)",
    "Final Status",
    "Website",
    "X Link",
    "X Handle",
    "Telegram",
    "Category",
    "Release Date",
    "Product Status",
    "The Grid Status",
    "Profile Name",
    "Root ID",
    "Matched URL",
    "Matched via",
    "Ecosystem/Chain",
    "Source",
    "Notes",
    "Evidence & Source URLs",
]
REQUIRED = ["Project Name", "Website", "Notes", "Evidence & Source URLs", "Source"]

NAME, WEBSITE, X_LINK, X_HANDLE, TELEGRAM = "Project Name", "Website", "X Link", "X Handle", "Telegram"
CATEGORY, SOURCE, NOTES, EVIDENCE = "Category", "Source", "Notes", "Evidence & Source URLs"
USDT, WEB3, STABLE = "Suspect USDT support?", "Web3 but no stablecoin", "General Stablecoin Adoption"
STATUS, PROFILE, ROOT, MATCHED_URL, VIA, CHAIN = "The Grid Status", "Profile Name", "Root ID", "Matched URL", "Matched via", "Ecosystem/Chain"
FLAGS = ["Suspect USDT support?", "Skip", "Added", "Web3 but no stablecoin", "General Stablecoin Adoption", "To be Added", "Processed?", "In Admin", "TG/TON appstore (no main URL)"]

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CATALOG])


def cell(c: str | Column) -> Column:
    """The column, null as the empty string; names with dots or spaces are taken whole."""
    return F.coalesce(F.col(f"`{c}`") if isinstance(c, str) else c, F.lit(""))


def trim(c: str | Column) -> Column:
    """Without outer white space of any kind (Spark's trim drops spaces only)."""
    return F.regexp_replace(cell(c), r"(?U)^\s+|\s+$", "")


def filled(c: str | Column) -> Column:
    return trim(c) != ""


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(trim(c), F.lit(""))


def is_true(c: str | Column) -> Column:
    return F.upper(trim(c)).isin("TRUE", "YES", "1")


def either(*cells: str | Column) -> Column:
    """The first cell that is filled, else empty."""
    return F.coalesce(*[blank_to_null(c) for c in cells], F.lit(""))


def appended(c: str | Column, extra: Column, by: str = " | ") -> Column:
    """The cell with ``extra`` after ``by``; only that where the cell is empty; as it was where ``extra`` is."""
    return F.when(F.coalesce(extra, F.lit("")) == "", cell(c)).when(filled(c), F.concat(trim(c), F.lit(by), extra)).otherwise(extra)


def parts(c: str | Column, by: str) -> Column:
    """The cell's non-empty parts, trimmed, in order."""
    import re

    return F.filter(F.transform(F.split(cell(c), re.escape(by)), trim), lambda x: x != "")


def with_columns_of(df: DataFrame, columns: Iterable[str] = CATALOG, chain: str | None = None) -> DataFrame:
    """``df`` with all ``columns``, absent ones empty (the chain's name in its column)."""
    fill = {c: F.lit(chain if chain and c == CHAIN else "") for c in columns if c not in df.columns}
    return df.withColumns(fill) if fill else df


def ordered(df: DataFrame, columns: Iterable[str] = CATALOG) -> DataFrame:
    """Canonical columns first, then the others as they came; canonical nulls become empty."""
    known = list(columns)
    df = with_columns_of(df, known)
    return df.select(*[cell(c).alias(c) for c in known], *[F.col(f"`{c}`") for c in df.columns if c not in known])


def missing_columns(df: DataFrame, required: Iterable[str] = REQUIRED) -> list[str]:
    return sorted(set(required) - set(df.columns))
